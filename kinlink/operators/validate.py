"""Checks of the outputs against the inputs, as anti-joins and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_ids


def bad_id_list(ids: Column) -> Column:
    """Whether a list repeats an id or holds one that is no S2-/S3- id of visible characters."""
    bad = lambda x: ~x.rlike(r'^S[23]-[^\s\x00-\x20\x7f-\x9f"]+$')
    return F.exists(ids, bad) | (F.size(F.array_distinct(ids)) != F.size(ids))


def validation_faults(sources: DataFrame, matches: DataFrame, candidates: DataFrame, targets: DataFrame) -> DataFrame:
    """``fault, example, n`` for every kind of fault; no rows if the outputs are right.

    ``sources`` has ``id, ord``; ``matches`` and ``candidates`` have ``ord,
    source1_entity_id`` and a comma-joined list; ``targets`` has ``id``.
    """
    src = sources.select(F.col("ord").alias("at"), F.col("id").alias("ref_id"))
    m = matches.select("ord", F.col("source1_entity_id").alias("m_id"), split_ids(F.col("matched_entity_ids")).alias("m"))
    c = candidates.select(
        F.col("ord").alias("c_ord"),
        F.col("source1_entity_id").alias("c_id"),
        split_ids(F.col("candidate_entity_ids")).alias("c"),
    )
    rows = src.join(m, F.col("at") == F.col("ord"), "full_outer").join(
        c, F.coalesce("at", "ord") == F.col("c_ord"), "full_outer"
    )
    example = F.coalesce("ref_id", "m_id", "c_id").alias("example")
    there = F.col("ref_id").isNotNull() & F.col("m_id").isNotNull() & F.col("c_id").isNotNull()
    tests = {
        "row missing or left over": ~there,
        "rows out of order": there & ((F.col("ref_id") != F.col("m_id")) | (F.col("ref_id") != F.col("c_id"))),
        "malformed id list": there & (bad_id_list(F.col("m")) | bad_id_list(F.col("c"))),
        "match that is no candidate": there & (F.size(F.array_except("m", "c")) > 0),
    }
    named = F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests.items()])
    faults = rows.select(F.explode(F.array_compact(named)).alias("fault"), example)
    twice = src.groupBy("ref_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    faults = faults.unionByName(twice.select(F.lit("reference twice").alias("fault"), F.col("ref_id").alias("example")))
    asked = c.select(F.explode("c").alias("id")).unionByName(m.select(F.explode("m").alias("id"))).distinct()
    unknown = asked.join(targets.select("id"), "id", "left_anti")
    faults = faults.unionByName(unknown.select(F.lit("unknown target id").alias("fault"), F.col("id").alias("example")))
    return faults.groupBy("fault").agg(F.min("example").alias("example"), F.count(F.lit(1)).alias("n"))


def unknown_ids(asked: DataFrame, targets: DataFrame, limit: int = 5) -> DataFrame:
    """The first ``limit`` distinct ids of ``asked`` (target_id) that no target has, in order."""
    ids = asked.select("target_id").distinct()
    return ids.join(targets.select(F.col("id").alias("target_id")), "target_id", "left_anti").orderBy("target_id").limit(limit)
