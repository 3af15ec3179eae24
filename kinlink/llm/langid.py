"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (one to
three characters, a word border counting as a character), most frequent first.
A document's own most frequent n-grams are compared to each profile by the
out-of-place distance: the sum of the differences of ranks, an n-gram missing
in the profile counting ``top``. The least distance wins, ties going to the
language that sorts first; ``score`` is one minus the distance's share of its
maximum.

Characters are the letters themselves, in lower case, whatever their script.
Whole texts are counted, in blocks.

Learning takes at most ``per_language`` rows of a language in expectation (a
threshold on a hash of the id, so that it is one scan and the same at every
size), of the ``languages`` most frequent values of ``lang``; counts are summed
per partition before they are shuffled.

A text that is null or has no letters is ``und`` with score 0, as is every text
if nothing could be learnt. Rows with null id or language are never learnt
from. Repeated rows count repeatedly. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import crc_of_id, remembered, small_batches

BITS = 18  # all letters lie below 2**18
BLOCK = 1 << 20
PAIRS, TRIPLES = 1 << 60, 1 << 61  # mark n-grams of two and three characters


def letters() -> np.ndarray:
    """Code point -> that of the letter in lower case; 0 is everything that is no letter."""

    def build() -> np.ndarray:
        table = np.zeros(0x110000, np.int64)
        for cp in range(1 << BITS):
            c = chr(cp)
            if c.isalpha():
                table[cp] = ord(c.lower()[0])
        return table

    return remembered(("langid", "letters"), build)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all parts, and their counts."""
    if len(parts) == 1:
        return parts[0]
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text and their counts; nothing if it has no letters."""
    table, parts = letters(), []
    last = np.zeros(2, np.int64)  # the two characters before a block
    some = False
    for at in range(0, len(text), BLOCK):
        c = table[np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        if at + BLOCK >= len(text):
            c = np.append(c, 0)
        border = c == 0
        before = np.concatenate([last[1:] == 0, border[:-1]])
        c = c[~(border & before)]  # one border between words
        if not len(c):
            continue
        joined = np.concatenate([last, c])
        one = joined[2:]
        two = (joined[1:-1] << BITS) + one
        three = (joined[:-2] << 2 * BITS) + two
        if not at:
            three = three[1:]
        grams = np.concatenate([one[one > 0], PAIRS + two, TRIPLES + three])
        parts.append(np.unique(grams, return_counts=True))
        some = some or bool((one > 0).any())
        last = joined[-2:]
    if not some:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return summed(parts)


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams; ties by their code."""
    return grams[np.lexsort((grams, -counts))[:top]]


def learn_profiles(
    docs: DataFrame,
    top: int = 400,
    per_language: int = 4000,
    languages: int = 1000,
    held_out: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> dict[str, list[int]]:
    """language -> its n-grams by rank, from rows that are not ``held_out``."""
    rows = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held = F.pmod(crc_of_id("id"), F.lit(4)) == 2 if held_out is None else held_out
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    ticket = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1_000_000)) / F.lit(1e6)
    sample = rows.join(F.broadcast(sizes), "lang").where(ticket < F.lit(per_language) / F.col("n")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(lang, [])
                own.append(gram_counts(text.as_py() or ""))
                if len(own) == 64:
                    sums[lang] = [summed(own)]
        for lang, own in sums.items():
            grams, counts = summed(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= top).collect()  # languages * top rows
    profiles: dict[str, list[int]] = {}
    for r in sorted(best, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Identifier:
    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.top, self.languages = top, sorted(profiles)
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *profiles.values()]).astype(np.int64))
        self.ranks = np.full((len(self.languages), len(self.known) + 1), -1, np.int64)  # the last place is for all others
        for k, lang in enumerate(self.languages):
            self.ranks[k, np.searchsorted(self.known, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams, counts = gram_counts(text or "")
        if not len(grams) or not self.languages:
            return "und", 0.0
        own = ranked(grams, counts, self.top)
        place = np.searchsorted(self.known, own).clip(0, len(self.known) - 1)
        theirs = self.ranks[:, np.where(self.known[place] == own, place, len(self.known))]
        apart = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(len(own)))).sum(1)
        best = int(apart.argmin())
        return self.languages[best], float(1 - apart[best] / (self.top * len(own)))


def language_column(text: Column, profiles: dict[str, list[int]], top: int = 400) -> Column:
    """A struct ``lang_pred, score`` for ``text``."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    tag = str(hash(str(sorted(profiles.items()))))

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        identifier = remembered(("langid", tag), lambda: Identifier(profiles, top))
        found = [identifier.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            ["lang_pred", "score"],
        )

    return predict(text.cast("string"))


def identify_languages(
    docs: DataFrame, profiles: dict[str, list[int]], top: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row."""
    held = F.coalesce(F.pmod(crc_of_id(id_col), F.lit(4)) == 2, F.lit(False))
    return small_batches(docs).select(
        F.col(id_col).alias("doc_id"),
        held.alias("held_out"),
        language_column(F.col(text_col), profiles, top).alias("found"),
    ).select("doc_id", "held_out", "found.*")
