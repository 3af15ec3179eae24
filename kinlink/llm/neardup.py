"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds the 64-bit hashes of its distinct word shingles (A-Z
lower-cased; words end at ASCII white space). Documents with equal sets form a
class at once, and only one of each class goes on; so any number of copies is
one node.

Candidates. Minwise hashes are dealt to bands; documents that agree on a band
share a bucket. Buckets are never expanded into all their pairs:

1. Each member is compared with the bucket's hub: its most central member, the
   one whose own buckets hold most rows. The original of many edited copies has
   the commonest bands, so it is the hub of nearly all their buckets.
2. Verified links give components, and each round contracts them: later rounds
   see links between components only. Buckets that still hold several
   components try other hubs, ``rounds`` times in all.
3. Buckets that even then hold several components are settled by differences.
   With a common document H, members x and y differ by the elements in which
   their differences from H differ, so a link needs many *shared differences*:
   at least (U(x) + U(y)) / (2 * (100 + percent)), where U(z) is (100 + percent)
   * |z ^ H| - (100 - percent) * |z|. Members not linked with H have a large U;
   by the prefix-filter principle two such differences must meet in a short
   prefix of their rarest elements. Prefixes are joined on (H, element);
   positions prune the meetings.
   Copies that were edited independently share next to no differences, so a
   group in which thousands of copies are unlike each other costs about as many
   rows as it has edits, and no pair is skipped.

Every two members of a bucket are then in one component, or were compared, or
were proved unlike; no link between components is lost but by the banding,
whose miss probability at similarity t is (1 - t**rows)**bands: 3e-6 at 0.8, and by
``banding`` at most 4e-6 at any other threshold that is asked for.

Comparison is sequential: one bit of each minwise hash, in batches of 64. After
each batch the posterior probability that the similarity reaches the threshold
(uniform prior) decides; below ``miss`` the pair is dropped. The bounds are a
table of least matches per batch, computed once. Survivors are verified exactly
on their whole sets.

Components are found by passing on smallest ids with pointer jumping, each
round written to the shared folder; nothing is collected but counts.

A document with fewer words than a shingle has one shingle, all its words. A
null or empty text has the empty set and links with nothing. Very long texts
are read whole. Rows with one id are one document: the components of all their
texts are one. Rows with a null id link with nothing and are kept (component
null). An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch, materialize, remembered, small_batches

ROWS, BATCH, BATCHES, ROUNDS = 5, 64, 8, 2
REMEMBERED = 200_000
SIGNATURE = [f"bits{k}" for k in range(BATCHES)]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finalizer of a well-known generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = remembered(("neardup", "words"), WordHashes)
    if len(hashes) >= REMEMBERED:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(words) - k + 1 + j])
    return np.unique(out)


class Signer:
    """Band keys and bit signature of a set."""

    def __init__(self, bands: int, rows: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        n = max(bands * rows, BATCH * BATCHES // 2)
        self.a = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, np.uint64)
        self.band_seed = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.full(2 * len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(shingles), 256):
            x = shingles[at : at + 256, None] * self.a + self.b
            np.minimum(least, x.view(np.uint32).min(0), out=least)  # each half is a minwise hash
        least = _mix(least.astype(np.uint64))
        halves = least[1::2]  # the upper halves make the bands
        keys = self.band_seed.copy()
        grid = halves[: self.bands * self.rows].reshape(self.bands, self.rows)
        for j in range(self.rows):
            keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + grid[:, j])
        bits = (least[: BATCH * BATCHES] & np.uint64(1)).astype(np.uint8)
        return keys.view(np.int64), np.packbits(bits).view(">u8").astype(np.uint64).view(np.int64)


def banding(threshold: float, missed: float = 4e-6) -> tuple[int, int]:
    """Bands and rows that miss a pair at the threshold with probability ``missed`` at most: the most rows with 64 bands or less."""
    for rows in range(ROWS, 0, -1):
        bands = 1 if threshold >= 1 else math.ceil(math.log(missed) / math.log1p(-(threshold**rows)))
        if bands <= 64 or rows == 1:
            return bands, rows
    raise AssertionError


def least_matches(threshold: float, miss: float) -> list[int]:
    """For 64, 128, ... compared bits: the fewest matches with posterior P(J >= threshold) >= miss.

    A bit matches with probability (1 + J) / 2; the prior of J is uniform.
    """
    j = (np.arange(20_000) + 0.5) / 20_000
    p = (1 + j) / 2
    out = []
    for n in range(BATCH, BATCH * BATCHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            density = np.exp(log - log.max())
            if density[j >= threshold].sum() / density.sum() >= miss:
                out.append(m)
                break
    return out


def _alike(a: str, b: str, bounds: list[int]):
    """The sequential comparison of the signatures of aliases ``a`` and ``b``."""
    differ, test = F.lit(0), None
    for k, (name, least) in enumerate(zip(SIGNATURE, bounds, strict=True)):
        differ = differ + F.bit_count(F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}")))
        passed = differ <= F.lit(BATCH * (k + 1) - least)
        test = passed if test is None else test & passed
    return test


def features(docs: DataFrame, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, set_key, bits0.., key0..`` per row; the latter are null for the empty set."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [*SIGNATURE, *[f"key{k}" for k in range(bands)]]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for batch in batches:
            sizes, digests = [], []
            table = np.zeros((batch.num_rows, len(names)), np.int64)
            for n, t in enumerate(batch.column(1)):
                s = shingle_set(t.as_py(), width)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    keys, bits = signer.sign(s)
                    table[n, :BATCHES], table[n, BATCHES:] = bits, keys
            empty = np.array([d is None for d in digests], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
                + [pa.array(np.ascontiguousarray(column), pa.int64(), mask=empty) for column in table.T],
                ["doc_id", "n_shingles", "set_key", *names],
            )

    schema = T.StructType(
        [slim.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType())]
        + [T.StructField(x, T.LongType()) for x in names]
    )
    return slim.mapInArrow(sign, schema)


def with_sets(texts: DataFrame, width: int) -> DataFrame:
    """The rows of ``id, set_key, bits0.., text`` whose text has the set of that key, with the set for the text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(batch.num_columns - 1)]
            same = [xxhash.xxh3_128_digest(s) == k.as_py() for s, k in zip(sets, batch.column(1), strict=True)]
            columns = [*batch.columns[:-1], pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names).filter(pa.array(same, pa.bool_()))

    schema = T.StructType([*texts.schema.fields[:-1], T.StructField("shingles", T.BinaryType())])
    return texts.mapInArrow(build, schema)


def _set(scalar) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), np.uint64)


def verify(pairs: DataFrame, percent: int) -> DataFrame:
    """Of rows ``a, b, set_a, set_b``: the pairs whose whole sets reach the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                one, two = _set(a), _set(b)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(check, T.StructType([pairs.schema["a"], pairs.schema["b"]]))


def differences(spokes: DataFrame, percent: int) -> DataFrame:
    """Of rows ``id, hub, comp, set_key, set, hub_set``: whether they are linked, and the elements of their difference.

    ``excess`` is U. A member that is the farther one of a pair must meet the
    other among its first ``n_far`` elements, in one order for all (none if it
    is linked with the hub), the nearer one among its first ``n_near``.
    """
    more, less = 100 + percent, 100 - percent

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            elements = []
            for a, b in zip(batch.column(4), batch.column(5), strict=True):
                own, hub = _set(a), _set(b)
                apart = np.setxor1d(own, hub, assume_unique=True)
                shared = (len(own) + len(hub) - len(apart)) // 2
                linked = 100 * shared >= percent * (len(own) + len(hub) - shared)
                excess = more * len(apart) - less * len(own)
                nearest = less * len(hub) + 1  # the least U of a member that is not linked with the hub
                least = lambda u: max(1, -(-u // (2 * more)))
                n_near = max(0, len(apart) - least(excess + max(excess, nearest)) + 1)
                n_far = 0 if linked else max(0, len(apart) - least(excess - less * len(hub)) + 1)
                elements.append(apart.view(np.int64))
                for column, value in zip(out, (linked, excess, len(apart), n_near, n_far), strict=True):
                    column.append(value)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in elements])]).astype(np.int32)
            flat = np.concatenate([*elements, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array(out[0], pa.bool_()),
                    *[pa.array(column, pa.int64()) for column in out[1:]],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                schema.names,
            )

    long = T.LongType()
    schema = T.StructType(
        [*spokes.schema.fields[:4], T.StructField("linked", T.BooleanType())]
        + [T.StructField(x, long) for x in ("excess", "size", "n_near", "n_far")]
        + [T.StructField("elements", T.ArrayType(long))]
    )
    return spokes.mapInArrow(compare, schema)


def prefixes(spokes: DataFrame) -> DataFrame:
    """A row for each element of the prefixes, ``at`` its place; rare elements of the hub's group come first."""
    each = spokes.where("n_near > 0 OR n_far > 0").select(
        "id", "hub", "comp", "set_key", "excess", "size", "n_near", "n_far", F.explode("elements").alias("element")
    )
    held = each.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("held"))
    place = F.row_number().over(Window.partitionBy("hub", "id", "set_key").orderBy("held", "element")) - 1
    posts = each.join(held, ["hub", "element"]).withColumn("at", place)
    return posts.where(F.col("at") < F.greatest("n_near", "n_far"))


def meetings(posts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``id, hub`` of members of different components whose differences from a document meet early enough."""
    far, near = posts.where("at < n_far").alias("f"), posts.where("at < n_near").alias("n")
    order = (F.col("f.excess") > F.col("n.excess")) | ((F.col("f.excess") == F.col("n.excess")) & (F.col("f.id") > F.col("n.id")))
    most = F.least(F.expr("f.size - f.at"), F.expr("n.size - n.at"))  # what the two can share from here on
    pairs = far.join(
        near,
        (F.col("f.hub") == F.col("n.hub"))
        & (F.col("f.element") == F.col("n.element"))
        & (F.col("f.comp") != F.col("n.comp"))
        & order
        & (most * (2 * (100 + percent)) >= F.col("f.excess") + F.col("n.excess")),
    )
    return pairs.select(F.col("f.id").alias("id"), F.col("n.id").alias("hub")).distinct()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``node, label`` for all ends of ``edges`` (a, b): label is the smallest node reachable."""
    keep = scratch.keep if scratch else materialize
    sym = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    sym = keep(sym.union(sym.select("v", "u")).distinct(), "edges")
    labels = sym.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label"))
    labels = keep(labels, "labels")
    while True:
        near = (
            sym.join(labels.select(F.col("node").alias("v"), F.col("label").alias("l")), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("l").alias("l"))
        )
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = keep(hooked.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels


def contracted(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``labels`` (node, label) after the links ``a, b`` have joined their components."""
    side = lambda end, name: labels.select(F.col("node").alias(end), F.col("label").alias(name))
    between = links.join(side("a", "u"), "a").join(side("b", "v"), "b").where("u <> v")
    between = scratch.keep(between.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "between")
    if between.isEmpty():
        return labels
    merged = components(between, scratch).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return scratch.keep(labels.join(merged, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
    bands: int | None = None,
    rows: int | None = None,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; links have 100 * |A & B| >= percent * |A | B|."""
    if not 1 <= percent <= 100 or rounds < 1:
        raise ValueError("percent must be from 1 to 100, rounds at least 1")
    chosen = banding(percent / 100)
    bands, rows = bands or chosen[0], rows or chosen[1]
    scratch = Scratch(docs.sparkSession)
    keep, bounds = scratch.keep, least_matches(percent / 100, miss)
    signed = materialize(features(small_batches(docs), width, bands, rows, id_col, text_col), "signed")
    usable = signed.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    keys = [f"key{k}" for k in range(bands)]
    # Rows of a class have one signature, so any of them will do.
    reps = usable.groupBy("set_key").agg(F.min("doc_id").alias("id"), *[F.any_value(c).alias(c) for c in [*SIGNATURE, *keys]])
    reps = keep(reps, "classes")

    banded = reps.select("id", F.explode(F.array(*keys)).alias("key"))
    full = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = keep(banded.join(full, "key"), "buckets")
    low = F.xxhash64("id").bitwiseAND(F.lit((1 << 20) - 1))
    central = buckets.groupBy("id").agg((F.shiftleft(F.sum("n"), 20) + F.any_value(low)).alias("score"))
    central = keep(central, "central")
    buckets = buckets.join(central, "id")
    hubs = buckets.groupBy("key").agg(F.max_by("id", "score").alias("hub"))
    buckets = keep(buckets.join(hubs, "key"), "hubs")

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    involved = reps.select("id", "set_key", *SIGNATURE).join(central.select("id"), "id", "left_semi")
    texts = involved.join(texts, "id").select("id", "set_key", *SIGNATURE, "text")
    nodes = keep(with_sets(texts, width), "nodes")
    labels = central.select(F.col("id").alias("node"), F.col("id").alias("label"))

    repeated = keep(usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    several_texts = not repeated.isEmpty()
    if several_texts:  # texts of one id are one document
        nodes = keep(nodes.dropDuplicates(["id", "set_key"]), "nodes")
        several = usable.select("doc_id", "set_key").join(repeated, "doc_id", "left_semi").distinct()
        several = several.join(reps.select("set_key", F.col("id").alias("a")), "set_key")
        first = several.groupBy("doc_id").agg(F.min("a").alias("b"))
        same = keep(several.join(first, "doc_id").select("a", "b").distinct(), "same")
        labels = keep(labels.unionByName(same.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct(), "labels")
        labels = contracted(labels, same, scratch)

    def links_of(pairs: DataFrame) -> DataFrame:
        """Of pairs ``id, hub``: those alike by signature, then by their whole sets."""
        one = pairs.join(nodes, "id").alias("x")
        near = one.join(nodes.withColumnRenamed("id", "hub").alias("y"), (F.col("x.hub") == F.col("y.hub")) & _alike("x", "y", bounds))
        near = near.select(
            F.col("x.id").alias("a"), F.col("x.hub").alias("b"), F.col("x.shingles").alias("set_a"), F.col("y.shingles").alias("set_b")
        )
        return keep(verify(near, percent), "links")

    labels = contracted(labels, links_of(buckets.where("id <> hub").select("id", "hub").distinct()), scratch)

    def mixed(members: DataFrame) -> DataFrame:
        """Rows ``key, id, score, comp`` of the buckets that still hold several components, with ``lead``, the most central one's."""
        named = keep(members.join(labels.select(F.col("node").alias("id"), F.col("label").alias("comp")), "id"), "members")
        leads = named.groupBy("key").agg(F.max_by("comp", "score").alias("lead"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        return keep(named.join(leads.where("low <> high").select("key", "lead"), "key"), "mixed")

    split = mixed(buckets.where("n > 2").select("key", "id", "score"))  # pairs have been compared
    for _ in range(rounds - 1):
        if split.isEmpty():
            break
        others = split.where("comp <> lead").groupBy("key").agg(F.max_by(F.struct("id", "comp"), "score").alias("hub"))
        pairs = split.join(others, "key").where("comp <> hub.comp").select("id", F.col("hub.id").alias("hub")).distinct()
        labels = contracted(labels, links_of(pairs), scratch)
        split = mixed(split.select("key", "id", "score"))

    if not split.isEmpty():
        comps = central.join(labels.select(F.col("node").alias("id"), F.col("label").alias("comp")), "id")
        centres = comps.groupBy("comp").agg(F.max_by("id", "score").alias("centre"), F.max("score").alias("weight"))
        hubs = split.select("key", "comp").distinct().join(centres, "comp").groupBy("key").agg(F.max_by("centre", "weight").alias("hub"))
        spokes = split.join(hubs, "key").select("id", "hub", "comp").distinct()
        sets = nodes.select("id", "set_key", F.col("shingles").alias("set"))
        centre = nodes.groupBy("id").agg(F.min("shingles").alias("hub_set")).withColumnRenamed("id", "hub")  # of one text, where an id has several
        spokes = spokes.join(sets, "id").join(centre if several_texts else sets.select(F.col("id").alias("hub"), F.col("set").alias("hub_set")), "hub")
        spokes = keep(differences(spokes.select("id", "hub", "comp", "set_key", "set", "hub_set"), percent), "differences")
        direct = spokes.where("linked AND id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
        pairs = keep(meetings(keep(prefixes(spokes), "prefixes"), percent), "meetings")
        labels = contracted(labels, direct.unionByName(links_of(pairs)), scratch)

    found = reps.select("set_key", F.col("id").alias("node")).join(labels, "node", "left")
    found = materialize(found.select("set_key", F.coalesce("label", "node").alias("comp")), "class-labels")
    scratch.clear()
    return (
        signed.select("doc_id", "n_shingles", "set_key")
        .join(found, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
