"""Chat formatting: collapse cumulative snapshots, then render.

A chat log often holds a conversation once per turn: every snapshot is a prefix
of the next. Only conversations that are no proper prefix of another are kept.

Each turn gets a digest of role and text. A turn's *term* hashes its position
and digest; the running sum of the terms (four 32-bit lanes, so no sum can
overflow) is a rolling hash of the turn prefix. A conversation is dropped by an
anti-join when its (length, hash) equals that of a proper prefix of another
one. Of identical conversations the smallest id is kept.

Sums run in cells of ``chunk`` consecutive turn numbers, with cell offsets
added, so a conversation of any length is not scanned by one task. Prefix keys
are made distinct by an aggregation (map-side combined) before the anti-join;
a first turn that a third of all conversations share is one row there.

Rendering gives one row per ``part`` of at most ``chunk`` turn numbers;
ordinary conversations have one part.

Nulls: rows without conv_id belong to no conversation and give no row; a null
turn sorts first; a null role renders as ``unknown``, a null text as empty.
Repeated (conv_id, turn, role, text) rows count once; different rows with one
turn number follow each other by digest. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize

LANES = ["lane0", "lane1", "lane2", "lane3"]
KEY = ["n_turns", *LANES]
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _turns(conversations: DataFrame, chunk: int) -> DataFrame:
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / F.lit(chunk)), F.lit(-1)).cast("long").alias("part"),
    )


def prefix_hashes(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """``conv_id, position, n_turns, lane0..lane3``: the rolling hash after each turn."""
    slim = (
        _turns(conversations, chunk)
        .select(
            "conv_id",
            "part",
            "turn",
            F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias(
                "digest"
            ),
        )
        .distinct()
    )
    slim = materialize(slim, "chat-turns")
    cell = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "digest")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = slim.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    terms = (
        slim.join(counts, ["conv_id", "part"])
        .withColumn("position", F.col("before") + F.row_number().over(cell))
        .withColumn("h0", F.xxhash64("position", "digest"))
        .withColumn("h1", F.xxhash64("digest", "position", F.lit(0x5EED)))
    )
    low = F.lit(0xFFFFFFFF).cast("long")
    for lane, (name, high) in zip(LANES, [("h0", False), ("h0", True), ("h1", False), ("h1", True)], strict=True):
        value = F.shiftrightunsigned(name, 32) if high else F.col(name).bitwiseAND(low)
        terms = terms.withColumn(lane, value)
    terms = materialize(terms.select("conv_id", "part", "position", *LANES), "chat-terms")
    sums = terms.groupBy("conv_id", "part").agg(*[F.sum(x).alias(x) for x in LANES])
    sums = sums.select(
        "conv_id", "part", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"before_{x}") for x in LANES]
    )
    running = Window.partitionBy("conv_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return terms.join(sums, ["conv_id", "part"]).select(
        "conv_id",
        F.col("position").cast("long").alias("n_turns"),
        *[(F.sum(x).over(running) + F.col(f"before_{x}")).alias(x) for x in LANES],
    )


def maximal_conversations(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """``conv_id, n_turns, copies``: the conversations that prefix no longer one."""
    prefixes = materialize(prefix_hashes(conversations, chunk), "chat-prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("n_turns").alias("length"))
    known = prefixes.join(lengths, "conv_id")
    complete = (
        known.where(F.col("n_turns") == F.col("length"))
        .groupBy(*KEY)
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    )
    proper = known.where(F.col("n_turns") < F.col("length")).select(*KEY).distinct()
    return complete.join(proper, KEY, "left_anti").select("conv_id", "n_turns", "copies")


def render_conversations(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """``conv_id, part, n_turns, copies, text`` of every maximal conversation."""
    kept = maximal_conversations(conversations, chunk)
    line = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))
    rendered = (
        _turns(conversations, chunk)
        .join(kept, "conv_id")
        .withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
        .groupBy("conv_id", "part", "n_turns", "copies")
        .agg(F.array_sort(F.collect_set(F.struct("turn", "digest", "role", "text"))).alias("turns"))
    )
    return rendered.select(
        "conv_id", "part", "n_turns", "copies", F.array_join(F.transform("turns", line), "").alias("text")
    )
