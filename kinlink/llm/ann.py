"""Nearest neighbours by inner product, over randomly rotated one-bit codes.

Each vector, less a centre, is padded with zeros to ``code_bits`` coordinates,
rotated at random and kept as the signs of its coordinates (packed bits) with
correction scalars: its distance from the centre, the inner product of its
direction with its code, and its inner product with the centre. For a query
these give an unbiased estimate of the inner product and an error bound, which
narrows with the root of ``code_bits``: eight bits a dimension leave a few in a
hundred vectors to be reranked, one bit nearly all.

A bounded sample of rows is fixed first (``sample`` rows, 8 MB at most). It
gives the centre, coarse cells, and for each query a floor: its (k+1)-th best
score within the sample, which its k-th best over all rows cannot be below. In
every block of codes a vector is reranked on its original components, in double
precision, only if its upper bound reaches the floor and the block's own k-th
greatest lower bound; the sample's own best are results at once, so no list is
short. A query is not sent to cells whose centroid and radius
prove all their vectors to be below its floor. The ranking by (score, id) is
exact for all reranked vectors; every row is indexed and bounded. What can be
missed is a vector whose true score exceeds the estimate by more than ``width``
standard errors.

Equal vectors are one class: a class carries its ``k + 1`` smallest ids, which
is all that a result of ``k`` can hold, and equal queries are searched once. So
a vector that a third of all rows repeat is one candidate.

The scan meets blocks of classes with blocks of distinct queries (blocks of
bounded size, dealt by hash within cells): the queries are a stated set against
all rows, so the work grows as queries times rows of the cells that cannot be
excluded.

Vectors that are null, zero, hold null or non-finite components, have a null
id, or another length than most vectors, take no part. Repeated rows count
once. An id with several vectors stands once in each list, with its best score;
as a query it asks with all its vectors. With no valid vectors the result is
empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import materialize

def rotation(dim: int, bits: int, seed: int = 6) -> np.ndarray:
    """``dim`` orthonormal rows of ``bits`` coordinates: padding and random rotation at once."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, dim)))
    return (q * np.sign(np.diag(r))).T


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple:
    """Packed signs, distance from the centre, fit of direction and code, product with the centre."""
    apart = vectors - centre
    far = np.linalg.norm(apart, axis=1)
    turned = (apart / np.where(far > 0, far, 1)[:, None]) @ turn
    fit = np.abs(turned).sum(1) / np.sqrt(turn.shape[1])
    return np.packbits(turned > 0, axis=1), far, np.where(far > 0, fit, 1.0), vectors @ centre


def signs_of(code: np.ndarray, bits: int) -> np.ndarray:
    return (np.unpackbits(code, axis=1, count=bits).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(bits))


def bounds(queries: np.ndarray, signs: np.ndarray, far, fit, with_centre, centre, turn, width: float):
    """Estimates of all inner products (queries by codes), and their error bounds."""
    bits = turn.shape[1]
    apart = queries - centre
    estimate = ((apart @ turn).astype(np.float32) @ signs.T) * (far / fit).astype(np.float32)
    estimate += (with_centre + (apart @ centre)[:, None]).astype(np.float32)
    loose = far * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / np.sqrt(max(1, bits - 1))
    error = (width * np.linalg.norm(apart, axis=1)).astype(np.float32)[:, None] * loose.astype(np.float32)
    return estimate, error + np.float32(1e-5) * (1 + np.abs(estimate))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components: the same to the last bit wherever they are taken."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1]


def cells_of(sample: np.ndarray, cells: int, turns: int = 5) -> np.ndarray:
    """Centroids by a few rounds of k-means on the sample."""
    centroids = np.unique(sample[:cells], axis=0)
    for _ in range(turns):
        own = nearest_cell(sample, centroids)[0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        held = np.bincount(own, minlength=len(centroids))
        centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centroids)
    return centroids


def nearest_cell(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, and its distance."""
    own = ((centroids**2).sum(1) - 2 * vectors @ centroids.T).argmin(1)
    return own, np.linalg.norm(vectors - centroids[own], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """``id, vec`` of the rows that take part, and their common length."""
    vec = F.col("vec")
    kind = vectors.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)  # kept as it is: half the bytes
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec")
    )
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0))
    lengths = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "n").head()
    dim = lengths["n"] if lengths else 0
    return rows.where(F.size("vec") == dim), dim


def nearest(
    vectors: DataFrame,
    k: int = 20,
    queries: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    width: float = 2.5,
    code_bits: int | None = None,
    sample: int = 16_384,
    cells: int = 64,
    block: int = 8192,
    query_block: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``queries`` is a condition on ``id`` (every 20th by default)."""
    spark = vectors.sparkSession
    asks = F.col("id") % 20 == 0 if queries is None else queries
    rows, dim = valid_vectors(vectors, id_col, vec_col)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    bits = code_bits or max(8 * dim, 256) if dim <= 512 else dim
    seen = rows.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(max(1, min(sample, (1 << 20) // dim))).toArrow()
    seen_ids, seen = seen.column(0).to_numpy(), _matrix(seen.column(1).combine_chunks(), dim)
    centre, centroids, turn = seen.mean(0), cells_of(seen, cells), rotation(dim, bits)

    first = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    classes = (
        rows.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )
    schema = T.StructType(
        [*classes.schema.fields, T.StructField("code", T.BinaryType())]
        + [T.StructField(x, T.DoubleType()) for x in ("far", "fit", "centre")]
        + [T.StructField("cell", T.IntegerType()), T.StructField("apart", T.DoubleType())]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(0), dim)
            packed, far, fit, with_centre = encode(v, centre, turn)
            cell, apart = nearest_cell(v, centroids)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p.tobytes() for p in packed], pa.binary()), *map(pa.array, (far, fit, with_centre))]
                + [pa.array(cell.astype(np.int32)), pa.array(apart)],
                schema.names,
            )

    classes = materialize(classes.mapInArrow(code, schema), "ann-codes")
    held = classes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("apart").alias("radius")).collect()  # a row for each cell
    radius = np.full(len(centroids), -np.inf)
    for r in held:
        radius[r["cell"]] = r["radius"] + 1e-9
    several = not rows.groupBy("id").agg(F.min("vec").alias("a"), F.max("vec").alias("b")).where("a <> b").isEmpty()

    asker = F.md5(F.to_json(F.struct("vec")).cast("binary"))
    asked = rows.where(asks).select(F.col("id").alias("query_id"), asker.alias("asker"), "vec")
    askers = asked.groupBy("asker").agg(F.any_value("vec").alias("vec"))
    asking = T.StructType([*askers.schema.fields, T.StructField("floor", T.DoubleType()), T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("seen_ids", T.ArrayType(T.LongType())), T.StructField("seen_scores", T.ArrayType(T.DoubleType()))])

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(seen_ids, kind="stable")
        ids, starts = np.unique(seen_ids[order], return_index=True)
        for batch in batches:
            q = _matrix(batch.column(1), dim)
            low, best, worth = np.full(len(q), -np.inf), [], []
            for at in range(0, len(q), 256):
                scores = np.maximum.reduceat(q[at : at + 256] @ seen[order].T, starts, axis=1)  # the best of each id
                if len(ids) > k:
                    low[at : at + 256] = np.partition(scores, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1] - 1e-9
            for x, floor in zip(q, low, strict=True):  # these are found already, exactly
                pick = np.flatnonzero(seen @ x >= floor)
                scores = products(seen[pick], x)
                top = np.lexsort((seen_ids[pick], -scores))[: 4 * (k + 1)]
                best.append(seen_ids[pick][top])
                worth.append(scores[top])
            reach = q @ centroids.T + np.linalg.norm(q, axis=1)[:, None] * radius
            lists = [np.flatnonzero(x >= f).astype(np.int32) for x, f in zip(np.where(np.isnan(reach), -np.inf, reach), low, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(low), pa.array(lists, pa.list_(pa.int32())), pa.array(best, pa.list_(pa.int64())), pa.array(worth, pa.list_(pa.float64()))],
                asking.names,
            )

    askers = materialize(askers.mapInArrow(floors, asking), "ann-askers")

    # Blocks of one cell each; small inputs are cut for all cores, large ones by ``block``.
    total = sum(r["n"] for r in held)
    size = min(block, max(1024, total // (3 * spark.sparkContext.defaultParallelism)))
    parts = F.create_map(*[F.lit(int(x)) for r in held for x in (r["cell"], -(-r["n"] // size))])
    n_query_blocks = max(1, -(-askers.count() // query_block))
    here = classes.withColumn("part", F.pmod(F.xxhash64("vec"), parts[F.col("cell")]).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))
    )
    there = (
        askers.withColumn("q", F.pmod(F.xxhash64("asker"), F.lit(n_query_blocks)).cast("int"))
        .withColumn("cell", F.explode("cells"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts[F.col("cell")].cast("int") - 1)))
        .select("q", "cell", "part", "asker", "vec", "floor")
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            v = _matrix(left.column("vec").combine_chunks(), dim)
            signs = signs_of(np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(len(v), -1), bits)
            far, fit, with_centre = (left.column(c).to_numpy() for c in ("far", "fit", "centre"))
            members = left.column("ids").to_pylist()
            names, low = right.column("asker").to_pylist(), right.column("floor").to_numpy()
            q_all = _matrix(right.column("vec").combine_chunks(), dim)
            m = min(k + 1, len(v))
            for at in range(0, len(q_all), 256):
                q, floor = q_all[at : at + 256], low[at : at + 256]
                estimate, error = bounds(q, signs, far, fit, with_centre, centre, turn, width)
                if not several:
                    floor = np.maximum(floor, np.partition(estimate - error, len(v) - m, axis=1)[:, len(v) - m])
                maybe = estimate + error >= floor[:, None]
                for r in range(len(q)):
                    pick = np.flatnonzero(maybe[r])
                    scores = products(v[pick], q[r])
                    pick, scores = pick[scores >= low[at + r]], scores[scores >= low[at + r]]
                    if not several and len(pick) > m:  # all classes that tie with the last stay
                        cut = np.partition(scores, len(pick) - m)[len(pick) - m]
                        pick, scores = pick[scores >= cut], scores[scores >= cut]
                    best = {}
                    for s, i in sorted((-s, i) for s, p in zip(scores.tolist(), pick.tolist(), strict=True) for i in members[p]):
                        if len(best) > k:
                            break
                        best.setdefault(i, -s)
                    out_q += [names[at + r]] * len(best)
                    out_v += best.keys()
                    out_s += best.values()
        return pa.table(
            {"asker": pa.array(out_q, pa.string()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())}
        )

    keys = ["q", "cell", "part"]
    found = here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(search, "asker string, vec_id long, score double")
    known = askers.select("asker", F.explode(F.arrays_zip("seen_ids", "seen_scores")).alias("x"))
    found = found.unionByName(known.select("asker", F.col("x.seen_ids").alias("vec_id"), F.col("x.seen_scores").alias("score")))
    found = found.groupBy("asker", "vec_id").agg(F.max("score").alias("score"))
    best = [F.desc("score"), F.asc("vec_id")]
    found = found.withColumn("n", F.row_number().over(Window.partitionBy("asker").orderBy(*best))).where(F.col("n") <= k + 1)
    found = materialize(found.drop("n"), "ann-found")
    ranked = asked.select("query_id", "asker").distinct().join(found, "asker").where("vec_id <> query_id")
    if several:
        ranked = ranked.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
