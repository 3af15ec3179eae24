"""Quoted TSV files: scans with exact headers, ordered single-file and folder sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The headers of the files.
SOURCE_HEADER = ["entity_id", "business_name", "business_address", "country"]
TRUTH_HEADER = ["source1_entity_id", "matched_entity_ids"]


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def check_header(spark: SparkSession, path: str, names: list[str]) -> None:
    """The first line must hold exactly these names, in this order and case."""
    found = [r.value for r in spark.read.text(path).limit(1).collect()]
    if not found or found[0].rstrip("\r").split("\t") != names:
        raise ValueError(f"unexpected header in {path}")


def scan_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of a TSV file whose fields may be quoted and hold tabs, quotes and line ends.

    A blank line, a short or long row, an unterminated quote or another header
    fails the scan. Missing fields are empty texts. A file is read by one task,
    as quoted line ends allow no cut.
    """
    check_header(spark, path, names)
    rows = spark.read.csv(
        path,
        schema=strings(names),
        sep="\t",
        quote='"',
        escape='"',
        multiLine=True,
        header=True,
        mode="FAILFAST",
        enforceSchema=False,
    )
    # The reader passes over blank lines; they are the lines that no row accounts for.
    ends = sum((F.regexp_count(F.coalesce(n, F.lit("")), F.lit("\r\n|\r|\n")) for n in names[:-1]), F.lit(0))
    last = F.regexp_count(F.regexp_replace(F.coalesce(names[-1], F.lit("")), "\r$", ""), F.lit("\r\n|\r|\n"))
    told = rows.select((1 + ends + last).alias("lines")).agg(F.coalesce(F.sum("lines"), F.lit(0))).head()[0]
    if spark.read.text(path).count() != 1 + told:
        raise ValueError(f"blank or broken lines in {path}")
    clean = {n: F.coalesce(n, F.lit("")) for n in names}
    clean[names[-1]] = F.regexp_replace(clean[names[-1]], "\r$", "")  # rows that end with CR LF under an LF header
    return rows.select(*[c.alias(n) for n, c in clean.items()])


def scan_source(spark: SparkSession, path: str, number: int) -> DataFrame:
    """One source's raw records, ids checked; ``source`` says which, ``ord`` keeps the file's order."""
    from ..operators.records import check_ids

    rows = check_ids(scan_tsv(spark, path, SOURCE_HEADER), f"S{number}-")
    return rows.withColumn("source", F.lit(f"S{number}")).withColumn("ord", F.monotonically_increasing_id())


def scan_truth(spark: SparkSession, path: str) -> DataFrame:
    """``ref_id, target_ids``; duplicate references and malformed id lists fail."""
    from ..functions.text import split_ids
    from ..operators.validate import bad_id_list

    rows = scan_tsv(spark, path, TRUTH_HEADER)
    ids = split_ids(F.col("matched_entity_ids"))
    rows = rows.select(F.col("source1_entity_id").alias("ref_id"), ids.alias("target_ids"))
    if not rows.where(bad_id_list(F.col("target_ids"))).isEmpty():
        raise ValueError("malformed list of target ids in the ground truth")
    if not rows.groupBy("ref_id").count().where("count > 1").isEmpty():
        raise ValueError("a reference occurs twice in the ground truth")
    return rows


def id_lists(refs: DataFrame, pairs: DataFrame, name: str, keep=None) -> DataFrame:
    """``ord, source1_entity_id, <name>``: each reference's target ids, sorted and comma-joined.

    References without pairs have the empty list. ``keep`` is a condition on
    the pairs.
    """
    rows = pairs if keep is None else pairs.where(keep)
    lists = rows.groupBy("ref_id").agg(F.array_sort(F.collect_list("target_id")).alias("ids"))
    joined = refs.select(F.col("id").alias("ref_id"), "ord").join(lists, "ref_id", "left")
    text = F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ",")
    return joined.select("ord", F.col("ref_id").alias("source1_entity_id"), text.alias(name))


def write_tsv_folder(rows: DataFrame, path: str) -> None:
    """Range-partitioned by ``ord``: the part files in name order hold the rows in order."""
    ordered = rows.repartitionByRange("ord").sortWithinPartitions("ord").drop("ord")
    ordered.write.csv(path, sep="\t", quote="", emptyValue="", header=True, mode="overwrite")


def read_tsv_folder(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The rows of :func:`write_tsv_folder` with their place, counted from 0 over all files.

    Places come from the files' row counts and each row's place in its block;
    no task sees all rows.
    """
    block = ["file", "start"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.split("value", "\t", -1).alias("fields"),
    )
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("at")) - 1
    lines = lines.withColumn("inside", inside - F.when(F.col("start") == 0, 1).otherwise(0)).where("inside >= 0")  # without headers
    counts = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))  # a row for each block of a file
    before = F.sum("n").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*block, F.coalesce(before, F.lit(0)).alias("before"))
    found = lines.join(counts, block)
    fields = [F.coalesce(F.get("fields", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)]
    return found.select((F.col("before") + F.col("inside")).alias("place"), *fields)


def _put(path: str | Path, chunks: Iterable[str]) -> None:
    """Write beside the target, then rename: readers see the old file or the whole new one."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    beside = target.parent / f"{target.name}-{uuid.uuid4().hex[:12]}.part"
    try:
        with beside.open("w", encoding="utf-8", newline="") as out:
            out.writelines(chunks)
        beside.replace(target)
    finally:
        beside.unlink(missing_ok=True)


def write_tsv_file(rows: DataFrame, path: str | Path) -> None:
    """One file in order, row by row through the driver, put in place whole."""
    names = [c for c in rows.columns if c != "ord"]
    lines = ("\t".join(r[n] for n in names) + "\n" for r in rows.orderBy("ord").toLocalIterator())
    _put(path, chain(["\t".join(names) + "\n"], lines))


def write_json(path: str | Path, value) -> None:
    _put(path, json.JSONEncoder(indent=2, sort_keys=True).iterencode(value))
