"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are the indexed collection and every passage of every training
document is a query. A passage is a window of ``2 * s`` words, moved by ``s``,
where ``s`` is the longest item's length; so each place where an item could
stand lies whole in some passage. A passage's distinct words are scored by BM25
against the items; impacts are divided by the item's score against itself, so
one threshold suits items of all lengths, and *all* items at or above it are
retrieved.

Postings are sorted by item and cut into blocks with their greatest impact.
WAND moves to the first item whose terms' bounds could reach the threshold, the
blocks' bounds decide whether it is scored or skipped. Passages are chosen in
the same way, for a whole document at once: a passage is looked up only if the
impacts of the rare terms in it can, with all common terms added, lift some
item to the threshold.

Retrieved items are verified on the passage: the share of the question's
shingles (five words) and the share of the answer's words, in runs of at least
two, must both reach their limits. The answer is what follows the last
``answer:`` or ``a:`` of an item, else its last sentence, else its last fifth.

The index is built for ``part`` items or ``part_bytes`` of their texts at a time
(a bound on what is shipped to the executors); more items mean more passes over
the documents. Counts, lengths and the width of passages are those of all items,
so the parts change no result. The items themselves, a benchmark and no corpus,
are held on the driver once.

Item ids may be of any type. Null and empty texts match nothing. Items with null id or text or without words
are ignored; with no items nothing matches. Repeated items give a row each.
Repeated documents give repeated rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from copy import copy
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import remembered, small_batches

WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
K1, B = 1.2, 0.75
BLOCK = 16
SHINGLE = 5
MARKER = re.compile(r"(?:\banswer|^\s*a)\s*:", re.I | re.M)
SENTENCE = re.compile(r"[.!?]\s+(?=\S)")
RESULT = [("score", T.DoubleType()), ("question", T.DoubleType()), ("answer", T.DoubleType())]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(WORDS).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    cuts = [m.span() for m in MARKER.finditer(text)] or [m.span() for m in SENTENCE.finditer(text)]
    if cuts:
        question, answer = words_of(text[: cuts[-1][0]]), words_of(text[cuts[-1][1] :])
        if question and len(answer) >= 2:
            return question, answer
    words = words_of(text)
    n = max(2, len(words) // 5)
    return (words[:-n], words[-n:]) if len(words) > n else (words, words)


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    k = min(SHINGLE, len(words))
    return set(zip(*[words[j:] for j in range(k)], strict=False)) if k else set()


class Totals:
    """Number, mean and greatest length of all items, and how many of them hold a word."""

    def __init__(self, items: list[tuple]):
        self.held: Counter[bytes] = Counter()
        lengths = []
        for _, text in items:
            if words := words_of(text):
                self.held.update(set(words))
                lengths.append(len(words))
        self.count, self.mean, self.stride = len(lengths), sum(lengths) / max(1, len(lengths)), max([1, *lengths])

    def of(self, items: list[tuple]) -> Totals:
        """The same, with only the words of ``items``."""
        own = copy(self)
        own.held = Counter({w: self.held[w] for _, text in items for w in words_of(text)})
        return own

    def key(self) -> tuple:
        return self.count, self.mean, self.stride, hash(frozenset(self.held.items()))


class Index:
    """BM25 postings of the items, with block bounds.

    ``totals`` are those of all items where these are only a part, so that scores do not depend on the parts.
    """

    def __init__(
        self, items: list[tuple], threshold: float, least_question: float, least_answer: float, totals: Totals | None = None
    ):
        totals = totals or Totals(items)
        self.threshold, self.limits = threshold, (least_question, least_answer)
        items = [(i, t, words_of(t)) for i, t in items]
        items = [(i, t, w) for i, t, w in items if w]
        self.ids = [i for i, _, _ in items]
        self.parts = [question_and_answer(t) for _, t, _ in items]
        self.questions = [shingles(q) for q, _ in self.parts]
        self.stride, held, mean = totals.stride, totals.held, totals.mean
        self.vocabulary = {t: k for k, t in enumerate(dict.fromkeys(t for _, _, w in items for t in w))}
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in self.vocabulary]
        for n, (_, _, w) in enumerate(items):
            impact = {}
            for t, tf in Counter(w).items():
                idf = math.log(1 + (totals.count - held[t] + 0.5) / (held[t] + 0.5))
                impact[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            whole = sum(impact.values())
            for t, x in impact.items():
                k = self.vocabulary[t]
                self.postings[k][0].append(n)
                self.postings[k][1].append(x / whole)
        self._tiers(len(items))
        self.most = [max(x) for _, x in self.postings]
        self.blocks = [
            [(p[0][min(at + BLOCK, len(p[0])) - 1], max(p[1][at : at + BLOCK])) for at in range(0, len(p[0]), BLOCK)]
            for p in self.postings
        ]

    def _tiers(self, n_items: int) -> None:
        """Rare terms as flat arrays; what each item's rare terms must give for it to reach the threshold."""
        df = np.array([len(p[0]) for p in self.postings], np.int64)
        owner = np.repeat(np.arange(len(df)), df)
        flat = np.array([i for p in self.postings for i in p[0]], np.int64)
        impact = np.array([x for p in self.postings for x in p[1]], np.float64)
        most = 0
        for most in sorted(set(df.tolist())):  # the fewest postings that leave little to common terms
            common = np.bincount(flat, impact * (df[owner] > most), n_items) if n_items else np.zeros(0)
            if not n_items or common.max() <= self.threshold / 2:
                break
        self.need = (self.threshold - common if n_items else np.zeros(0)) - 1e-9
        self.rare_df = np.append(np.where(df <= most, df, 0), 0)  # the last place is for all other words
        self.rare_at = np.append(np.cumsum(df) - df, 0)
        self.flat, self.impact = flat, impact

    def windows(self, numbers: np.ndarray) -> np.ndarray:
        """The passages in which some item's rare terms can lift it to the threshold.

        Passage ``k`` is blocks ``k`` and ``k + 1`` of ``stride`` words. Every
        occurrence counts, so this is an upper bound.
        """
        count = self.rare_df[numbers]
        at = np.flatnonzero(count)
        if not len(at):
            return at
        count, n = count[at], len(self.ids)
        first = np.repeat(self.rare_at[numbers[at]] - (np.cumsum(count) - count), count)
        where = first + np.arange(len(first))
        key = np.repeat(at // self.stride, count) * n + self.flat[where]
        keys, inverse = np.unique(key, return_inverse=True)
        here = np.bincount(inverse, self.impact[where])
        beside = np.searchsorted(keys, keys + n).clip(0, len(keys) - 1)
        both = here + np.where(keys[beside] == keys + n, here[beside], 0.0)
        need = self.need[keys % n]
        blocks = keys // n
        found = np.concatenate([blocks[both >= need], blocks[here >= need] - 1])
        return np.unique(found[found >= 0])

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All (item, score) at or above the threshold, by block-max WAND."""
        least, end = self.threshold - 1e-9, len(self.ids)
        at = {t: 0 for t in terms}  # term -> place in its postings
        found = []
        postings, most, blocks = self.postings, self.most, self.blocks

        def item(t):
            p = postings[t][0]
            return p[at[t]] if at[t] < len(p) else end

        def move(t, target):
            p, k = postings[t][0], at[t]
            block = k // BLOCK
            while block < len(blocks[t]) and blocks[t][block][0] < target:
                block += 1
            k = max(k, block * BLOCK)
            while k < len(p) and p[k] < target:
                k += 1
            at[t] = k

        order = sorted(at, key=item)
        while True:
            bound, pivot = 0.0, end
            for n, t in enumerate(order):  # the first item that the terms' bounds can lift to the threshold
                if (here := item(t)) == end:
                    break
                bound += most[t]
                if bound >= least:
                    pivot = here
                    break
            if pivot == end:
                return found
            while n + 1 < len(order) and item(order[n + 1]) == pivot:
                n += 1
            bound, last = 0.0, end
            for t in order[: n + 1]:
                block = at[t] // BLOCK
                while block < len(blocks[t]) and blocks[t][block][0] < pivot:
                    block += 1
                if block < len(blocks[t]):
                    bound += blocks[t][block][1]
                    last = min(last, blocks[t][block][0])
            if bound < least:  # no item before the nearest block border, or the next term, can do it
                target = max(pivot, last) + 1
                if n + 1 < len(order):
                    target = min(target, max(pivot + 1, item(order[n + 1])))
                for t in order[: n + 1]:
                    move(t, target)
            elif item(order[0]) == pivot:
                score = 0.0
                for t in order[: n + 1]:
                    score += postings[t][1][at[t]]
                    at[t] += 1
                if score >= least:
                    found.append((pivot, score))
            else:
                for t in order[: n + 1]:
                    move(t, pivot)
            order.sort(key=item)

    def verified(self, n: int, words: list[bytes], own: set) -> tuple[float, float]:
        """Shares of the question's shingles and of the answer's words that the passage has."""
        question, answer = self.questions[n], self.parts[n][1]
        pairs = set(zip(words, words[1:], strict=False))
        covered = [False] * len(answer)
        for j, pair in enumerate(zip(answer, answer[1:], strict=False)):
            if pair in pairs:
                covered[j] = covered[j + 1] = True
        k = min(SHINGLE, len(self.parts[n][0]))
        if k < SHINGLE:
            own = set(zip(*[words[j:] for j in range(k)], strict=False))
        return len(question & own) / max(1, len(question)), sum(covered) / max(1, len(answer))

    def leaks(self, text: str | None) -> list[dict]:
        words = words_of(text)
        if not words or not self.ids:
            return []
        numbers = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        s, best = self.stride, {}
        for k in self.windows(numbers).tolist():
            a, b = k * s, min((k + 2) * s, len(words))
            if k and a + s >= len(words):
                continue  # whole in the window before
            terms = np.unique(numbers[a:b])
            hits = self.retrieve(terms[terms >= 0].tolist())
            if not hits:
                continue
            passage = words[a:b]
            own = shingles(passage)
            for n, score in hits:
                question, answer = self.verified(n, passage, own)
                if question >= self.limits[0] and answer >= self.limits[1]:
                    best[n] = max(best.get(n, (0.0, 0.0, 0.0)), (score, question, answer))
        return [
            {"item_id": self.ids[n], "score": s, "question": q, "answer": r} for n, (s, q, r) in sorted(best.items())
        ]


def leaks_column(
    text: Column,
    items: list[tuple],
    threshold: float,
    least_question: float,
    least_answer: float,
    totals: Totals | None = None,
    id_type: T.DataType | None = None,
) -> Column:
    """An array of what ``text`` leaks: item_id, score, question, answer."""
    names = [("item_id", id_type or T.LongType()), *RESULT]
    kind = T.ArrayType(T.StructType([T.StructField(*x) for x in names]))
    arrow = to_arrow_type(kind)
    tag = (hash(tuple(items)), threshold, least_question, least_answer, totals and totals.key())

    @F.arrow_udf(kind)
    def find(texts: pa.Array) -> pa.Array:
        # Each part is a kind of its own: a worker holds one index.
        index = remembered((f"bm25 {tag}",), lambda: Index(items, threshold, least_question, least_answer, totals))
        return pa.array([index.leaks(t.as_py()) for t in texts], arrow)

    return find(text.cast("string"))


def item_parts(items: DataFrame, part: int, part_bytes: int = 16 << 20) -> list[tuple[list[tuple], Totals]]:
    """The items on the driver, in parts, each with the totals of all."""
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", F.col("text").cast("string"))
    parts: list[list[tuple]] = [[]]
    held = 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if len(parts[-1]) == part or held + len(r[1]) > part_bytes and parts[-1]:
            parts.append([])
            held = 0
        parts[-1].append((r[0], r[1]))
        held += len(r[1])
    totals = Totals([x for own in parts for x in own])
    return [(own, totals.of(own)) for own in parts]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.6,
    least_question: float = 0.5,
    least_answer: float = 0.5,
    part: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, question, answer``: one row per document row and leaked item."""
    found = None
    for own, totals in item_parts(items, part):
        column = leaks_column(F.col(text_col), own, threshold, least_question, least_answer, totals, items.schema["item_id"].dataType)
        some = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.explode(column).alias("leak")).select("doc_id", "leak.*")
        found = some if found is None else found.unionByName(some)
    return found


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.6,
    least_question: float = 0.5,
    least_answer: float = 0.5,
    part: int = 20_000,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item."""
    for own, totals in item_parts(items, part):
        column = leaks_column(F.col(text_col), own, threshold, least_question, least_answer, totals, items.schema["item_id"].dataType)
        docs = small_batches(docs).where(F.size(column) == 0)
    return docs
