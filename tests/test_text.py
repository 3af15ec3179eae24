import random

import pytest
from pyspark.sql import functions as F

from kinlink.functions import similarity as sim
from kinlink.functions import text as t


def values(spark, texts, build):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string")
    return [r.v for r in df.select("i", build(F.col("s")).alias("v")).orderBy("i").collect()]


def fnv(text):
    h = 14695981039346656037
    for b in text.encode():
        h = ((h ^ b) * 1099511628211) % 2**64
    return h


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Café Étoile SARL", "cafe etoile"),
        ("The Smith & Sons, Ltd.", "smith sons"),
        ("ÁRBOL Œuvre naïve Straße", "Árbol Œuvre naive straße"),
        ("", ""),
        ("the and", ""),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert values(spark, [raw], t.normalize_name) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Smith & Sons Lane", "smith and sons ln"),
        ("North Korea", "n korea"),
        ("A-1 St. Mary's", "a 1 st mary s"),
        ("12 Main\tRoad\nSuite 4", "12 main rd ste 4"),
    ],
)
def test_normalize_address(spark, raw, expected):
    assert values(spark, [raw], t.normalize_address) == [expected]


def test_hash(spark):
    ids = ["S1-0", "S1-1", "S1-7", "S1-42", "", "Café Étoile", "日本"]
    assert [int(v) for v in values(spark, ids, t.hash64)] == [fnv(x) for x in ids]
    assert values(spark, ids, lambda c: t.hash_mod(c, 1000)) == [fnv(x) % 1000 for x in ids]
    assert values(spark, ids, t.fold_of) == [fnv("evaluation:" + x) % 10 for x in ids]


def brute_dice(a, b):
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = ([s[i : i + 2] for i in range(len(s) - 1)] for s in (a.encode(), b.encode()))
    if not x or not y:
        return 0.0
    n = sum(min(x.count(g), y.count(g)) for g in set(x))
    return 2 * n / (len(x) + len(y))


def test_dice_is_that_of_byte_bigram_multisets(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aabé日 ") for _ in range(r.randint(0, 12)))
    rows = [(i, word(), word()) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = df.select("i", sim.dice(F.col("a"), F.col("b"), sim.tagged_bigrams(F.col("a")), sim.tagged_bigrams(F.col("b"))).alias("v"))
    found = {x.i: x.v for x in df.collect()}
    assert all(abs(found[i] - brute_dice(a, b)) < 1e-6 for i, a, b in rows)


def test_longest_first_and_ids(spark):
    assert values(spark, ["bb a ccc dd bb éé"], lambda c: F.array_join(t.longest_first(t.words(c)), " ")) == ["éé ccc bb dd a"]
    assert values(spark, ["", "a", "a,b"], lambda c: F.size(t.split_ids(c))) == [0, 1, 2]
