"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its distinct words and their leading four and five
bytes (insults are inflected), hashed to 2**20 places. The machine scores

    bias + sum w_i + sum over pairs <v_i, v_j>

over the chosen terms a document has, so that a pair (an insult beside the
mention of a group) can weigh more than its parts.

Learning takes at most ``per_class`` labelled ids of each class, the first in
the order of a hash of the id (exact bound, the same rows whatever the
partitioning), and of these as many as have ``most_places`` terms in all; so
very long texts cannot fill the driver. Of several texts of one id that of the
smallest digest teaches. From these the driver chooses the terms whose document
frequency differs most between the classes, and frequent terms beside them for
their pairs, and fits by AdaGrad with a fixed seed. Rows are weighted back to
the class shares of all labelled rows. Scoring reads whole texts.

Without labels of both classes every score is the share of label 1 (0 if there
are none). Null and empty texts have no terms and get the bias. Rows with a
null id or label are never learnt from; of several labels of one id the
highest holds. Repeated rows get equal scores, an empty table gives none.

The screen looks at terms one by one, so a pair of rare terms that are harmless
alone cannot be learnt unless both are among the frequent ones; and at most
``n_terms`` of the 2**20 places score at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import crc_of_id, materialize, remembered, small_batches

PLACES = 1 << 20
WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
REMEMBERED = 200_000
PART = 500  # texts whose terms are looked at together


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode("utf-8", "replace").translate(WORDS).split())


def places_of(word: bytes) -> tuple[int, ...]:
    """Hashed places of a word and of its beginnings."""
    found = [zlib.crc32(b"w" + word)]
    found += [zlib.crc32(b"%d" % n + word[:n]) for n in (4, 5) if len(word) > n]
    return tuple(x % PLACES for x in found)


class Machine:
    """The fitted model: chosen places, bias, weights and factors."""

    def __init__(self, places: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.places, self.bias, self.weights, self.factors = places, bias, weights, factors

    def logit(self, terms: np.ndarray) -> float:
        if not len(terms):
            return self.bias
        v = self.factors[terms]
        return float(self.bias + self.weights[terms].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))


class Terms(dict):
    """word -> the numbers of the chosen terms it has."""

    def __init__(self, places: np.ndarray):
        super().__init__()
        self.number = {int(p): k for k, p in enumerate(places)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = tuple(k for p in places_of(word) if (k := self.number.get(p)) is not None)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


def _sample(docs: DataFrame, labels: DataFrame, per_class: int, held_out, id_col: str, text_col: str):
    """Labelled training texts and the number of labelled rows of each class."""
    held = (lambda c: F.pmod(crc_of_id(c), F.lit(5)) == 0) if held_out is None else held_out
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held("id"))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("id", F.lit("toxicity")), F.col("id")]
    one = known.where("toxic = 1").orderBy(*order).limit(per_class)
    zero = known.where("toxic = 0").orderBy(*order).limit(per_class)
    chosen = one.unionByName(zero)  # at most 2 * per_class rows
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "toxic", "text"), sizes


def learn(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 6000,
    most_places: int = 8_000_000,
    n_terms: int = 2048,
    n_factors: int = 8,
    epochs: int = 12,
    steps: int = 800,
    held_out=None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Machine:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic); ``held_out``: id column name -> Column."""
    sample, sizes = _sample(docs, labels, per_class, held_out, id_col, text_col)
    none = np.empty(0, np.int64), np.empty(0), np.empty((0, n_factors))
    if not sizes.get(1) or not sizes.get(0):
        share = 1.0 if sizes.get(1) else 0.0
        return Machine(none[0], 20.0 * (2 * share - 1), none[1], none[2])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [
                sorted(set(chain.from_iterable(map(places_of, words_of(t.as_py()))))) for t in batch.column(2)
            ]
            digests = [xxhash.xxh3_64_intdigest(t.as_py() or "") >> 1 for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.int64()), pa.array(lists, pa.list_(pa.int32()))],
                schema.names,
            )

    schema = T.StructType(
        [sample.schema["id"], T.StructField("toxic", T.IntegerType()), T.StructField("digest", T.LongType())]
        + [T.StructField("places", T.ArrayType(T.IntegerType()))]
    )
    each = sample.mapInArrow(hashed, schema).groupBy("id").agg(F.min(F.struct("digest", "toxic", "places")).alias("x"))
    each = materialize(each.select("id", "x.toxic", "x.places", F.size("x.places").alias("n")), "toxicity-sample")
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("id", F.lit("toxicity")), "id")  # 2 * per_class ids
    taken = each.select("id", "toxic", F.sum("n").over(before).alias("so_far")).where(F.col("so_far") <= most_places // 2)
    table = each.join(taken.select("id"), "id", "left_semi").select("id", "toxic", "places").toArrow().sort_by([("id", "ascending")]).combine_chunks()
    y = table.column("toxic").to_numpy().astype(np.float64)
    lists = table.column("places").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    del table

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and places of ``PART`` texts at a time: arrays over all places would take a multiple of the table."""
        for at in range(0, len(lists), PART):
            some = lists.slice(at, PART)
            yield np.repeat(np.arange(at, at + len(some)), some.value_lengths().to_numpy()), some.flatten().to_numpy()

    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    df1, df0 = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
    for owner, flat in parts():
        df1 += np.bincount(flat[y[owner] == 1], minlength=PLACES)
        df0 += np.bincount(flat[y[owner] == 0], minlength=PLACES)
    p = (df1 + df0) / (n1 + n0)
    z = (df1 / n1 - df0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    z[df1 + df0 < 3] = 0
    strong = np.argsort(-np.abs(z), kind="stable")[: n_terms * 15 // 16]
    strong = strong[np.abs(z[strong]) > 4.5]  # by chance, a few of a million terms
    often = np.argsort(-(df1 + df0), kind="stable")[: n_terms // 16]
    places = np.union1d(strong, often[(df1 + df0)[often] > 0])
    if not len(places):
        return Machine(none[0], float(np.log(sizes[1] / sizes[0])), none[1], none[2])

    x = np.zeros((len(y), len(places)), np.uint8)
    for owner, flat in parts():
        where = np.searchsorted(places, flat).clip(0, len(places) - 1)
        hit = places[where] == flat
        x[owner[hit], where[hit]] = 1
    del lists, owner, flat, where, hit
    pa.default_memory_pool().release_unused()
    weight = np.where(y == 1, sizes[1] / n1, sizes[0] / n0)
    weight = weight / weight.mean()
    rng = np.random.default_rng(20)
    bias = float(np.log(sizes[1] / sizes[0]))
    w, v = np.zeros(len(places)), rng.normal(0, 0.01, (len(places), n_factors))
    gb, gw, gv = 1e-8, np.full(len(places), 1e-8), np.full(v.shape, 1e-8)
    rate = 0.1
    # Priors, as penalties on the mean loss; terms chosen only for their pairs must earn their weights.
    decay = np.where(np.isin(places, strong), 1.0, 30.0) / len(y)
    for _ in range(max(epochs, -(-steps * 128 // len(y)))):  # a few rows are seen more often
        order = rng.permutation(len(y))
        for at in range(0, len(y), 128):
            k = order[at : at + 128]
            xb = x[k].astype(np.float64)
            xv = xb @ v
            logit = bias + xb @ w + 0.5 * ((xv**2).sum(1) - xb @ (v**2).sum(1))
            slope = weight[k] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[k]) / len(k)
            db, dw = slope.sum(), xb.T @ slope + decay * w
            dv = xb.T @ (slope[:, None] * xv) - v * (xb.T @ slope)[:, None] + 5 * decay[:, None] * v
            gb, gw, gv = gb + db**2, gw + dw**2, gv + dv**2
            bias -= rate * db / np.sqrt(gb)
            w -= rate * dw / np.sqrt(gw)
            v -= rate / 5 * dv / np.sqrt(gv)
    return Machine(places, float(bias), w, v)


def toxicity_column(text: Column, machine: Machine) -> Column:
    """The probability that ``text`` is toxic."""
    state = (machine.places, machine.bias, machine.weights, machine.factors)
    tag = zlib.crc32(np.concatenate([machine.places, machine.weights, [machine.bias]]).tobytes())

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        model, terms = remembered(("toxicity", tag), lambda: (Machine(*state), Terms(state[0])))
        logits = [
            model.logit(np.array(sorted(set(chain.from_iterable(map(terms.__getitem__, words_of(t.as_py()))))), np.int64))
            for t in texts
        ]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -30, 30))), pa.float64())

    return score(text.cast("string"))


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    held = F.coalesce(F.pmod(crc_of_id(id_col), F.lit(5)) == 0, F.lit(False))
    return small_batches(docs).select(
        F.col(id_col).alias("doc_id"), held.alias("held_out"), toxicity_column(F.col(text_col), machine).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
