"""Contiguous shards of near-equal byte size, from global prefix sums.

Documents are laid out in one global order: by the digest of their text, then
by a salt of the id, then by id. Equal texts (a *group*) are therefore next to
each other. A document's place on the byte axis is the sum of the sizes before
it, and shard ``s`` of ``n`` covers ``[s * total / n, (s + 1) * total / n)``.

The prefix sum is never one sequential scan:

* digests are dealt to ``2 ** bucket_bits`` buckets by their leading bits;
  per-bucket totals (a fixed number of rows) give each bucket's offset;
* a window inside each bucket gives the offsets of its groups, one row per
  *distinct* text, after a map-side combine;
* inside a group all sizes are equal, so only the rank is needed. Groups are
  cut into ``salts`` cells by a hash of the id, so that a text which a third of
  all documents repeat is still ranked by many tasks.

A group whose bytes are at most ``whole_share`` of a shard's target stays in
one shard (that of its first byte); larger groups are cut at the targets.

Nulls: a null text counts as the empty text; a null id sorts first. Repeated
rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize, text_or_empty

GROUP = ["digest", "size", "text_crc32"]


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 8,
    whole_share: float = 0.05,
    bucket_bits: int = 13,
    salts: int = 256,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document."""
    if n_shards < 1 or not 1 <= bucket_bits <= 31 or salts < 1:
        raise ValueError("n_shards, salts and bucket_bits must be positive")
    text = text_or_empty(text_col)
    raw = text.cast("binary")
    slim = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.md5(raw)).alias("digest"),
            (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(salts)), F.lit(0)).cast("int").alias("cell"),
        ),
        "shard-slim",
    )
    cells = slim.groupBy(*GROUP, "cell").agg(F.count(F.lit(1)).alias("cell_n"))
    in_group = Window.partitionBy(*GROUP).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(
        cells.withColumn("cell_offset", F.coalesce(F.sum("cell_n").over(in_group), F.lit(0))), "shard-cells"
    )

    leading = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    groups = (
        cells.groupBy(*GROUP)
        .agg(F.sum("cell_n").alias("group_n"))
        .withColumn("group_bytes", F.col("group_n") * F.col("size"))
        .withColumn("bucket", F.shiftrightunsigned(leading, 32 - bucket_bits).cast("int"))
    )
    # At most 2 ** bucket_bits rows, whatever the input: small enough for one task.
    totals = groups.groupBy("bucket").agg(
        F.sum("group_bytes").alias("bucket_bytes"), F.sum("group_n").alias("bucket_n")
    )
    whole = Window.partitionBy(F.lit(0))
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bucket_bytes").over(before), F.lit(0)).alias("bucket_start"),
        F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("bucket_row"),
        F.sum("bucket_bytes").over(whole).alias("total"),
    )
    in_bucket = Window.partitionBy("bucket").orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, -1)
    n = F.lit(n_shards).cast("long")
    groups = (
        groups.withColumn("start", F.coalesce(F.sum("group_bytes").over(in_bucket), F.lit(0)))
        .withColumn("row", F.coalesce(F.sum("group_n").over(in_bucket), F.lit(0)))
        .join(F.broadcast(offsets), "bucket")
        .withColumn("start", F.col("start") + F.col("bucket_start"))
        .withColumn("row", F.col("row") + F.col("bucket_row"))
        .withColumn("is_whole", F.col("group_bytes") * n <= F.col("total") * F.lit(float(whole_share)))
        .select(*GROUP, "group_n", "start", "row", "total", "is_whole")
    )
    groups = materialize(groups, "shard-groups")

    def shard_at(position):
        return F.least(F.expr(f"({position}) * {n_shards} div total"), n - 1)

    # The first row of each shard follows from the groups alone.
    first = shard_at("start")
    last = F.when(F.col("is_whole"), first).otherwise(shard_at("start + (group_n - 1) * size"))
    starts = (
        groups.withColumn("first_shard", first)
        .withColumn("shard", F.explode(F.sequence(first, last)))
        .withColumn(
            "rank",
            F.when(F.col("shard") == F.col("first_shard"), F.lit(0).cast("long")).otherwise(
                F.expr(f"(shard * total - start * {n_shards} + size * {n_shards} - 1) div (size * {n_shards})")
            ),
        )
        .groupBy("shard")
        .agg(F.min(F.col("row") + F.col("rank")).alias("shard_row"))
    )

    by_cell = Window.partitionBy(*GROUP, "cell").orderBy("doc_id")
    placed = (
        slim.join(cells.join(groups, GROUP), [*GROUP, "cell"])
        .withColumn("rank", F.col("cell_offset") + F.row_number().over(by_cell) - 1)
        .withColumn(
            "shard",
            F.when(F.col("is_whole"), shard_at("start")).otherwise(shard_at("start + rank * size")),
        )
    )
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("row") + F.col("rank") - F.col("shard_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
