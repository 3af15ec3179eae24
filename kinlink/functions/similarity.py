"""Similarities of two records' texts, as float columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as t


def as_float(x: Column) -> Column:
    return x.cast("float")


def tagged_bigrams(s: Column) -> Column:
    """The byte bigrams of ``s``, each tagged with its occurrence number.

    With tags, the intersection of two *sets* counts the intersection of the
    multisets. Computed once per record, not per pair.
    """
    n = F.octet_length(s)
    places = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    grams = t.let(
        t.hex_bytes(s), lambda digits: F.array_sort(F.transform(places, lambda i: F.substr(digits, 2 * i - 1, F.lit(4))))
    )
    tag = lambda g, i, own: F.conv(g, 16, 10).cast("long") * 65536 + (i + 1 - F.array_position(own, g))
    return t.let(grams, lambda own: F.transform(own, lambda g, i: tag(g, i, own)))


def _counts(s: str) -> np.ndarray:
    raw = np.frombuffer(s.encode(), np.uint8).astype(np.int64)
    return np.bincount(raw[:-1] * 256 + raw[1:], minlength=1 << 16)


def _shared_bigrams(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
    return pa.array([int(np.minimum(_counts(x), _counts(y)).sum()) for x, y in pairs], pa.int64())


def shared_bigrams(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of the byte bigrams of texts of any length.

    Linear in the text, where the tags of ``tagged_bigrams`` take quadratic time.
    """
    return F.arrow_udf(_shared_bigrams, "long")(a, b)


def dice(a: Column, b: Column, tags_a: Column, tags_b: Column) -> Column:
    shared = F.size(F.array_intersect(tags_a, tags_b))
    return as_float(
        F.when((a == "") | (b == ""), 0.0)
        .when(a == b, 1.0)
        .when((F.size(tags_a) == 0) | (F.size(tags_b) == 0), 0.0)
        .otherwise((2 * shared).cast("double") / (F.size(tags_a) + F.size(tags_b)))
    )


def set_intersection(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    shared = set_intersection(a, b)
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - shared
    return as_float(F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared.cast("double") / union))


def containment(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return as_float(
        F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(set_intersection(a, b).cast("double") / least)
    )


def length_ratio(a: Column, b: Column) -> Column:
    x, y = F.octet_length(a), F.octet_length(b)
    return as_float(F.when((x == 0) | (y == 0), 0.0).otherwise(F.least(x, y).cast("double") / F.greatest(x, y)))


def rank(name_dice: Column, address_dice: Column) -> Column:
    f = lambda x: F.lit(x).cast("float")
    return as_float(f(0.65) * name_dice + f(0.35) * address_dice)
