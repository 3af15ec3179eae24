"""Gradient-boosted oblivious trees over the pair features.

All nodes of a level ask the same question, so a tree is ``DEPTH`` pairs of
feature and border and one value for each of the ``2**DEPTH`` answers. Splits
maximise the second-order gain of the log loss with an L2 penalty; leaves take
one Newton step. Nothing is drawn at random: the same pairs give the same model,
whatever their partitioning.

Fitting uses every pair it is given. Borders are those of all values, and a pair
is held as the numbers of its cells, a byte a feature. Sums of a level's leaves and
cells are of whole numbers (``UNIT``), so they are exact and come out the same wherever
they are made: in this process up to ``MOST_HELD`` pairs, by a Spark job for each level
beyond, in which only sums go to the driver. Tuning and scoring are distributed too.

A null or non-finite feature is an error. Without pairs the probability is 0.5,
with one label alone it is that label's smoothed share; there are no trees then.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import FEATURES

# The training parameters.
DEPTH, RATE, L2, PATIENCE = 6, 0.06, 5.0, 50
MOST_BORDERS = 128

MOST_HELD, BLOCK = 4_000_000, 65_536  # pairs; those held take about 30 bytes each
MOST_TOGETHER = 1024  # combinations of cells that are counted in one pass
UNIT = 1 << 30  # slopes and bends are summed in multiples of 1 / UNIT
STEP, FRESH = 4, 100  # trees after which logits are kept, and kept anew from the first ones


class Tree(NamedTuple):
    """``values[i]`` holds where bit ``d`` of ``i`` tells whether ``features[d]`` is above ``borders[d]``."""

    features: list[int]
    borders: list[float]
    values: list[float]
    gains: list[float]


class Trees(NamedTuple):
    bias: float
    trees: list[Tree]

    def first(self, n: int) -> Trees:
        """The model as it was after ``n`` trees."""
        return Trees(self.bias, self.trees[:n])

    def stages(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The logits after each tree."""
        logit = np.full(len(x), self.bias)
        for tree in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for d, (feature, border) in enumerate(zip(tree.features, tree.borders, strict=True)):
                leaf |= (x[:, feature] > border).astype(np.int64) << d
            logit = logit + np.asarray(tree.values)[leaf]
            yield logit

    def logit(self, x: np.ndarray) -> np.ndarray:
        last = np.full(len(x), self.bias)
        for last in self.stages(x):
            pass
        return last


def _matrix(columns: list[pa.Array]) -> np.ndarray:
    x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])
    if not np.isfinite(x).all():
        raise ValueError("a feature is null or not finite")
    return x


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _borders(values: np.ndarray) -> np.ndarray:
    """Borders between the distinct values, at most ``MOST_BORDERS``, at equal ranks if there are more."""
    seen = np.unique(values)
    if len(seen) > MOST_BORDERS + 1:
        seen = np.unique(np.quantile(values, np.linspace(0, 1, MOST_BORDERS + 1), method="nearest"))
    return (seen[:-1] + seen[1:]) / 2


class Block(NamedTuple):
    """Some pairs: the cell of each (a row a feature), labels and logits."""

    cells: np.ndarray
    y: np.ndarray
    logit: np.ndarray


#: The pairs above a cell of a feature; a tree's splits and values.
Split = tuple[int, int]
Grown = tuple[list[Split], np.ndarray]


def _cells(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(b, column, "left") for column, b in zip(x.T, borders, strict=True) if len(b)]).astype(np.uint8)


def _leaves(cells: np.ndarray, splits: list[Split]) -> np.ndarray:
    leaf = np.zeros(cells.shape[1], np.uint8)
    for d, (k, cell) in enumerate(splits):
        leaf |= (cells[k] > cell).view(np.uint8) << np.uint8(d)
    return leaf


def _after(block: Block, trees: list[Grown]) -> Block:
    logit = block.logit
    for splits, values in trees:
        logit = logit + values[_leaves(block.cells, splits)]
    return block._replace(logit=logit)


def _passes(sizes: list[int]) -> list[list[int]]:
    """The features, those of few cells in groups whose combinations of cells are counted together."""
    passes: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if passes and math.prod(sizes[j] for j in passes[-1]) * sizes[k] <= MOST_TOGETHER:
            passes[-1].append(k)
        else:
            passes.append([k])
    return passes


def _sums(blocks: Iterable[Block], sizes: list[int], splits: list[Split]) -> np.ndarray:
    """Slopes and bends of each leaf (second axis) and cell (third), in multiples of 1 / ``UNIT``."""
    leaves, passes, parts = 1 << len(splits), _passes(sizes), [None] * len(sizes)
    totals = [np.zeros((2, leaves * math.prod(sizes[k] for k in group)), np.int64) for group in passes]
    for block in blocks:
        p = _probability(block.logit)
        weights = np.rint((p - block.y) * UNIT), np.rint(p * (1 - p) * UNIT)
        leaf = _leaves(block.cells, splits).astype(np.int64)
        for group, total in zip(passes, totals, strict=True):
            place = block.cells[group[0]].astype(np.uint16)
            for k in group[1:]:
                place = place * np.uint16(sizes[k]) + block.cells[k]
            place = leaf * (total.shape[1] // leaves) + place
            for of, weight in zip(total, weights, strict=True):  # whole numbers, below 2**53 in a block
                of += np.bincount(place, weight, len(of)).astype(np.int64)
    for group, total in zip(passes, totals, strict=True):
        cube = total.reshape(2, leaves, *(sizes[k] for k in group))
        for axis, k in enumerate(group, 2):
            parts[k] = cube.sum(tuple(a for a in range(2, cube.ndim) if a != axis))
    return np.concatenate(parts, axis=2)


class Held:
    """Sums of blocks in this process."""

    def __init__(self, blocks: list[Block], sizes: list[int]):
        self.blocks, self.sizes, self.known = blocks, sizes, 0

    def sums(self, trees: list[Grown], splits: list[Split]) -> np.ndarray:
        if len(trees) > self.known:
            self.blocks, self.known = [_after(b, trees[self.known :]) for b in self.blocks], len(trees)
        return _sums(self.blocks, self.sizes, splits)


class Spread:
    """The same sums of blocks that stay on the executors."""

    def __init__(self, blocks: RDD, sizes: list[int]):
        self.first = self.now = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.sizes, self.known = sizes, 0

    def sums(self, trees: list[Grown], splits: list[Split]) -> np.ndarray:
        if len(trees) >= self.known + STEP:
            # From the first blocks now and then, so that a lost block is made again by few steps.
            source, done = (self.first, trees[:]) if len(trees) % FRESH < STEP else (self.now, trees[self.known :])
            later = source.map(lambda b: _after(b, done)).persist(StorageLevel.MEMORY_AND_DISK)
            later.count()
            self.forget()
            self.now, self.known = later, len(trees)
        new, sizes = trees[self.known :], self.sizes
        parts = self.now.mapPartitions(lambda blocks: [_sums((_after(b, new) for b in blocks), sizes, splits)])
        return np.sum(parts.collect(), axis=0)

    def forget(self, all_of_it: bool = False) -> None:
        if self.now is not self.first or all_of_it:
            self.now.unpersist()
        if all_of_it:
            self.first.unpersist()


def _grow(bias: float, borders: list[np.ndarray], iterations: int, summed: Callable[[list[Grown], list[Split]], np.ndarray]) -> Trees:
    used = [k for k, b in enumerate(borders) if len(b)]
    # Cells of all features lie in one row: feature ``used[k]`` has those from ``start[k]`` to ``last[k]``.
    sizes = np.array([len(borders[k]) + 1 for k in used])
    start = sizes.cumsum() - sizes
    last = start + sizes - 1
    owner, trees, grown = np.repeat(np.arange(len(used)), sizes), [], []

    def low_and_high(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = found.cumsum(1)
        below = np.where(start > 0, sums[:, start - 1], 0)
        low = sums - below[:, owner]
        return low / UNIT, (low[:, last][:, owner] - low) / UNIT

    for _ in range(iterations):
        splits, gains, chosen, ends = [], [], [], None
        for _ in range(DEPTH):
            (g_low, g_high), (h_low, h_high) = map(low_and_high, summed(grown, splits))
            worth = (g_low**2 / (h_low + L2) + g_high**2 / (h_high + L2)).sum(0)
            if not splits:
                before = float(worth[last[0]])  # all pairs are below the last border
            worth[last] = -np.inf  # above it there is none
            cell = int(worth.argmax())
            gain = float(worth[cell] - before)
            if gain <= 1e-9:
                break
            k = int(owner[cell])
            splits.append((k, cell - int(start[k])))
            chosen.append((used[k], float(borders[used[k]][cell - start[k]])))
            gains.append(gain)
            ends = [np.concatenate([low[:, cell], high[:, cell]]) for low, high in ((g_low, g_high), (h_low, h_high))]
            before = float(worth[cell])
        if ends is None:
            break
        values = -RATE * ends[0] / (ends[1] + L2)
        grown.append((splits, values))
        trees.append(Tree([f for f, _ in chosen], [b for _, b in chosen], values.tolist(), gains))
    return Trees(bias, trees)


def _start(n: int, positive: int, borders: list[np.ndarray]) -> tuple[float, list[int]]:
    """The bias, and the number of cells of each feature that has several; none if nothing can be learnt."""
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    return bias, [len(b) + 1 for b in borders if len(b)] if 0 < positive < n else []


def boost(x: np.ndarray, y: np.ndarray, iterations: int) -> Trees:
    """Fit on a matrix of features and a vector of labels 0 and 1."""
    borders = [_borders(column) for column in x.T] if len(y) else []
    bias, sizes = _start(len(y), int(y.sum()), borders)
    if not sizes:
        return Trees(bias, [])
    parts = [slice(at, at + BLOCK) for at in range(0, len(y), BLOCK)]
    held = Held([Block(_cells(x[part], borders), y[part], np.full(len(y[part]), bias)) for part in parts], sizes)
    return _grow(bias, borders, iterations, held.sums)


def _seen(pairs: DataFrame, total: int) -> tuple[int, list[np.ndarray]]:
    """The number of links, and the borders of each feature as ``_borders`` has them, of all pairs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, column in enumerate(_matrix(batch.columns).T):
                values, times = np.unique(column, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, np.int32)), pa.array(values), pa.array(times)], ["k", "v", "n"])

    values = pairs.mapInArrow(counted, "k int, v double, n long").groupBy("k", "v").agg(F.sum("n").alias("n"))
    each = Window.partitionBy("k")  # distinct values of a column, with their numbers
    values = values.select("k", "v", "n", F.sum("n").over(each.orderBy("v")).alias("upto"), F.count(F.lit(1)).over(each).alias("different"))
    ranks = F.lit([int(rank) for rank in np.rint((total - 1) * np.linspace(0, 1, MOST_BORDERS + 1))])
    at_rank = F.exists(ranks, lambda rank: (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")))
    rows = values.where((F.col("different") <= MOST_BORDERS + 1) | at_rank).select("k", "v", "n").collect()
    found = [np.array(sorted(r["v"] for r in rows if r["k"] == k)) for k in range(1, len(FEATURES) + 1)]
    return sum(r["n"] for r in rows if r["k"] == 0 and r["v"] > 0), [(v[:-1] + v[1:]) / 2 for v in found]


def _blocks(pairs: DataFrame, borders: list[np.ndarray]) -> DataFrame:
    """``cells, y`` of up to ``BLOCK`` pairs in a row, as bytes."""

    def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        cells, y = (np.concatenate(p, axis=-1).tobytes() for p in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([cells], pa.binary()), pa.array([y], pa.binary())], ["cells", "y"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            x = _matrix(batch.columns)
            if n and n + len(x) > BLOCK:
                yield packed(parts)
                parts, n = [], 0
            parts.append((_cells(x[:, 1:], borders), x[:, 0].astype(np.uint8)))
            n += len(x)
        if n:
            yield packed(parts)

    return pairs.mapInArrow(encode, "cells binary, y binary")


def _block(cells: bytes, y: bytes, bias: float) -> Block:
    labels = np.frombuffer(y, np.uint8)
    return Block(np.frombuffer(cells, np.uint8).reshape(-1, len(labels)), labels, np.full(len(labels), bias))


def fit(pairs: DataFrame, iterations: int, most_pairs: int | None = None) -> Trees:
    """``pairs`` has ids, features and ``label``; all are used.

    Only a caller that asks for it by ``most_pairs`` gets so many in expectation, those of the smallest hashes of both ids.
    """
    total = pairs.count()
    if most_pairs is not None and total > most_pairs:
        place = F.xxhash64("ref_id", "target_id").bitwiseAND(F.lit((1 << 40) - 1))
        pairs = pairs.where(place < F.lit(int((1 << 40) * most_pairs / total)))
        total = pairs.count()
    numbers = pairs.select(*[F.col(c).cast("double").alias(c) for c in ("label", *FEATURES)])
    positive, borders = _seen(numbers, total)
    bias, sizes = _start(total, positive, borders)
    if not sizes:
        return Trees(bias, [])
    blocks = _blocks(numbers, borders)
    if total <= MOST_HELD:
        table = blocks.toArrow()
        held = [_block(c.as_py(), y.as_py(), bias) for c, y in zip(table.column("cells"), table.column("y"), strict=True)]
        return _grow(bias, borders, iterations, Held(held, sizes).sums)
    parts = blocks.repartition(pairs.sparkSession.sparkContext.defaultParallelism)
    spread = Spread(parts.rdd.map(lambda row: _block(row["cells"], row["y"], bias)), sizes)
    try:
        return _grow(bias, borders, iterations, spread.sums)
    finally:
        spread.forget(all_of_it=True)


def losses(model: Trees, pairs: DataFrame) -> list[float]:
    """The mean log loss after each tree, over all pairs."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = 2 * batch.column(0).to_numpy(zero_copy_only=False) - 1
            sums = [float(np.logaddexp(0, -y * logit).sum()) for logit in model.stages(_matrix(batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64())), pa.array([len(y)], pa.int64())], ["sums", "n"])

    schema = T.StructType([T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])
    parts = pairs.select(F.col("label").cast("double"), *FEATURES).mapInArrow(summed, schema)
    means = parts.select(F.posexplode("sums").alias("k", "loss"), "n").groupBy("k").agg((F.sum("loss") / F.sum("n")).alias("loss"))
    # Rounded, as the order of partial sums is not fixed.
    return [round(r["loss"], 12) for r in means.orderBy("k").collect()]


def best_iterations(model: Trees, tuning: DataFrame, patience: int = PATIENCE) -> int:
    """The number of trees after which the tuning loss did not fall for ``patience`` trees; all without tuning pairs."""
    best, seen = 0, losses(model, tuning)
    if not seen:
        return len(model.trees)
    for k, loss in enumerate(seen):
        if loss < seen[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def score(model: Trees, pairs: DataFrame) -> DataFrame:
    """Adds ``probability`` of a link."""

    @F.arrow_udf(T.DoubleType())
    def probability(*columns: pa.Array) -> pa.Array:
        return pa.array(_probability(model.logit(_matrix(list(columns)))), pa.float64())

    return pairs.withColumn("probability", probability(*[F.col(f) for f in FEATURES]))


def importance(model: Trees) -> dict[str, float]:
    """Each feature's share of all gains."""
    total = dict.fromkeys(FEATURES, 0.0)
    for tree in model.trees:
        for feature, gain in zip(tree.features, tree.gains, strict=True):
            total[FEATURES[feature]] += gain
    everything = sum(total.values()) or 1.0
    return {name: gain / everything for name, gain in total.items()}


def save(model: Trees, folder: str | Path) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    state = {"bias": model.bias, "trees": [tree._asdict() for tree in model.trees]}
    Path(folder, "trees.json").write_text(json.dumps(state, sort_keys=True))


def load(folder: str | Path) -> Trees:
    state = json.loads(Path(folder, "trees.json").read_text())
    return Trees(state["bias"], [Tree(**tree) for tree in state["trees"]])


def check_classes(labelled: DataFrame) -> None:
    """Fitting and tuning need pairs of both labels; the holdout needs an entity."""
    seen = {(r["split"], r["label"]) for r in labelled.select("split", "label").distinct().collect()}
    for name in ("fitting", "tuning"):
        if {(name, 0), (name, 1)} - seen:
            raise ValueError(f"the {name} split needs pairs of both labels; increase the sample")
