"""Blocking keys, candidate pairs and the bounded choice among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as t

NAME_LEAST, RANK_LEAST = 0.12, 0.27
MAX_TOKENS, MAX_PLACES, MAX_NUMBERS = 4, 5, 4
KINDS = "NSAWDL"


def key_tokens() -> Column:
    """The up to four longest name tokens; of these, those with at least three bytes."""
    longest = F.slice(t.longest_first(F.col("name_words")), 1, MAX_TOKENS)
    return F.filter(longest, lambda w: F.octet_length(w) >= 3)


def key_places() -> Column:
    """Prefixes of the first address words with five bytes or more that begin with no digit."""
    fit = F.filter(
        t.unique_words(F.col("address_words")), lambda w: (F.octet_length(w) >= 5) & ~w.rlike("^[0-9]")
    )
    return F.transform(F.slice(fit, 1, MAX_PLACES), lambda w: t.prefix(w, 5))


def key_arrays() -> dict[str, Column]:
    """For each kind of key, its keys of a record, without the country."""
    has_name, has_address = F.col("name") != "", F.col("address") != ""
    none = F.array().cast("array<string>")
    one = lambda when, key: F.when(when, F.array(key)).otherwise(none)
    tokens, places = key_tokens(), key_places()
    nums = F.slice(F.col("nums"), 1, MAX_NUMBERS)
    crossed = lambda kind, others: F.flatten(
        F.transform(
            tokens,
            lambda w: F.transform(others, lambda x: F.concat(F.lit(kind), t.prefix(w, 4), F.lit("|"), x)),
        )
    )
    return {
        "N": one(has_name, F.concat(F.lit("N"), "name_compact")),
        "S": one(has_name, F.concat(F.lit("S"), "name_sorted")),
        "A": one(has_address, F.concat(F.lit("A"), "address_compact")),
        "W": F.transform(tokens, lambda w: F.concat(F.lit("W"), w)),
        "D": crossed("D", nums),
        "L": crossed("L", places),
    }


def blocking_keys(records: DataFrame, kinds: str = KINDS) -> DataFrame:
    """``id, key``: distinct keys per record, each with the country before it."""
    arrays = key_arrays()
    every = F.array_distinct(F.concat(*[arrays[k] for k in kinds]))
    return records.select("id", "country", F.explode(every).alias("k")).select(
        "id", F.concat("country", F.lit("|"), "k").alias("key")
    )


def hashed(keys: DataFrame) -> DataFrame:
    """Keys as 64-bit numbers: eight bytes to shuffle, compare and sort."""
    return keys.withColumn("key", F.xxhash64("key"))


def key_frequencies(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def capped_postings(ref_keys: DataFrame, cap: int) -> DataFrame:
    """Postings of keys that at most ``cap`` references hold.

    A window group limit cuts every key to ``cap + 1`` rows before the shuffle,
    on each map task; a key that still has ``cap + 1`` is dropped. So a key that
    a third of all references hold brings each task ``cap + 1`` rows a map task
    at most. ``ref_keys`` holds a reference once for each key.
    """
    by_key = Window.partitionBy("key")
    few = ref_keys.withColumn("place", F.row_number().over(by_key.orderBy("id"))).where(F.col("place") <= cap + 1)
    return few.withColumn("n", F.max("place").over(by_key)).where(F.col("n") <= cap).select(*ref_keys.columns)


def candidate_hits(ref_keys: DataFrame, target_keys: DataFrame) -> DataFrame:
    """Distinct ``ref_id, target_id`` that share a key; nothing wider is joined yet."""
    return (
        ref_keys.withColumnRenamed("id", "ref_id")
        .join(target_keys.withColumnRenamed("id", "target_id"), "key")
        .select("ref_id", "target_id")
        .distinct()
    )


def _side(records: DataFrame, side: str, names: list[str]) -> DataFrame:
    return records.select(F.col("id").alias(f"{side}_id"), *[F.col(n).alias(f"{side}_{n}") for n in names])


def plausible_pairs(hits: DataFrame, refs: DataFrame, targets: DataFrame) -> DataFrame:
    """Hits past country, name and rank filters, with ``name_dice, address_dice, rank``."""
    names = ["country", "name_compact", "address_compact", "name_grams", "address_grams"]
    pairs = hits.join(_side(refs, "ref", names), "ref_id").join(_side(targets, "target", names), "target_id")
    pairs = pairs.where(F.col("ref_country") == F.col("target_country"))
    both = lambda n: (F.col(f"ref_{n}"), F.col(f"target_{n}"))
    pairs = pairs.withColumn("name_dice", sim.dice(*both("name_compact"), *both("name_grams")))
    pairs = pairs.where(F.col("name_dice") >= F.lit(NAME_LEAST).cast("float"))
    pairs = pairs.withColumn("address_dice", sim.dice(*both("address_compact"), *both("address_grams")))
    pairs = pairs.withColumn("rank", sim.rank(F.col("name_dice"), F.col("address_dice")))
    pairs = pairs.where(F.col("rank") >= F.lit(RANK_LEAST).cast("float"))
    return pairs.select("ref_id", "target_id", "ref_country", "name_dice", "address_dice", "rank")


def best_of_each_pair(pairs: DataFrame) -> DataFrame:
    """One row for each reference and target: that of the highest rank."""
    rest = [c for c in pairs.columns if c not in ("ref_id", "target_id")]
    best = F.max(F.struct("rank", *[c for c in rest if c != "rank"])).alias("best")
    return pairs.groupBy("ref_id", "target_id").agg(best).select(*[f"best.{c}" if c in rest else c for c in pairs.columns])


def top_candidates(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each reference by rank, ties to the smaller target id."""
    if k < 1:
        raise ValueError("k must be positive")
    best = Window.partitionBy("ref_id").orderBy(F.desc("rank"), F.asc("target_id"))
    return pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def retrieve(
    refs: DataFrame, targets: DataFrame, k: int = 12, cap: int = 64, mod: int = 1, keep: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Candidates of the sampled references, and the pairs they were chosen from.

    ``refs`` and ``targets`` are prepared records. The cap counts all
    references; sampling comes after it.
    """
    from .records import select_sample

    postings = capped_postings(hashed(blocking_keys(refs)), cap)
    if keep < mod:
        postings = select_sample(postings, mod, keep)
    hits = candidate_hits(postings, hashed(blocking_keys(targets)))
    pairs = plausible_pairs(hits, refs, targets)
    return top_candidates(pairs, k), pairs
