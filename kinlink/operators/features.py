"""The 22 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as t

# The features' names, in their order.
FEATURES = [
    "name_bigram_dice", "name_token_jaccard", "name_token_containment", "name_sorted_bigram_dice",
    "name_exact", "name_length_ratio", "name_first_token", "address_bigram_dice",
    "address_token_jaccard", "address_token_containment", "address_exact", "address_length_ratio",
    "number_jaccard", "first_number_equal", "postal_like_number_jaccard", "postal_like_number_conflict",
    "name_missing", "address_missing", "number_missing", "name_address_product",
    "name_address_minimum", "retrieval_score",
]
CARRIED = [
    "name", "address", "name_words", "address_words", "nums", "name_compact", "address_compact", "name_sorted", "name_sorted_grams",
]


def feature_columns() -> dict[str, Column]:
    """Feature -> expression over ``ref_*``, ``target_*``, the two dices and the rank."""
    both = lambda n: (F.col(f"ref_{n}"), F.col(f"target_{n}"))
    flag = lambda x: x.cast("float")
    same = lambda n: flag((both(n)[0] != "") & (both(n)[0] == both(n)[1]))
    empty = lambda n: flag((F.size(both(n)[0]) == 0) | (F.size(both(n)[1]) == 0))
    first = lambda n: F.coalesce(flag(F.get(both(n)[0], F.lit(0)) == F.get(both(n)[1], F.lit(0))), F.lit(0.0).cast("float"))
    postal = tuple(t.long_numbers(x) for x in both("nums"))
    has_postal = (F.size(postal[0]) > 0) & (F.size(postal[1]) > 0)
    return {
        "name_bigram_dice": F.col("name_dice"),
        "name_token_jaccard": sim.jaccard(*both("name_words")),
        "name_token_containment": sim.containment(*both("name_words")),
        "name_sorted_bigram_dice": sim.dice(*both("name_sorted"), *both("name_sorted_grams")),
        "name_exact": same("name_compact"),
        "name_length_ratio": sim.length_ratio(*both("name_compact")),
        "name_first_token": first("name_words"),
        "address_bigram_dice": F.col("address_dice"),
        "address_token_jaccard": sim.jaccard(*both("address_words")),
        "address_token_containment": sim.containment(*both("address_words")),
        "address_exact": same("address_compact"),
        "address_length_ratio": sim.length_ratio(*both("address_compact")),
        "number_jaccard": sim.jaccard(*both("nums")),
        "first_number_equal": first("nums"),
        "postal_like_number_jaccard": sim.jaccard(*postal),
        "postal_like_number_conflict": flag(has_postal & ~F.arrays_overlap(*postal)),
        "name_missing": flag((both("name")[0] == "") | (both("name")[1] == "")),
        "address_missing": flag((both("address")[0] == "") | (both("address")[1] == "")),
        "number_missing": empty("nums"),
        "name_address_product": F.col("name_dice") * F.col("address_dice"),
        "name_address_minimum": F.least("name_dice", "address_dice"),
        "retrieval_score": F.col("rank"),
    }


def pair_features(candidates: DataFrame, refs: DataFrame, targets: DataFrame) -> DataFrame:
    """``ref_id, target_id, rank`` and the features, only for chosen candidates."""
    side = lambda d, s: d.select(F.col("id").alias(f"{s}_id"), *[F.col(n).alias(f"{s}_{n}") for n in CARRIED])
    pairs = candidates.join(side(refs, "ref"), "ref_id").join(side(targets, "target"), "target_id")
    columns = feature_columns()
    return pairs.select("ref_id", "target_id", "rank", *[columns[f].alias(f) for f in FEATURES])
