"""From raw source rows to records with the arrays that later steps share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as t

RAW = ["entity_id", "business_name", "business_address", "country"]


def check_ids(raw: DataFrame, prefix: str) -> DataFrame:
    """Fail on an id that lacks the prefix or has nothing after it."""
    good = F.col("entity_id").startswith(prefix) & (F.length("entity_id") > len(prefix))
    return raw.withColumn(
        "entity_id",
        F.when(F.coalesce(good, F.lit(False)), F.col("entity_id")).otherwise(
            F.raise_error(F.concat(F.lit(f"not an id with prefix {prefix}: "), F.coalesce("entity_id", F.lit("null"))))
        ),
    )


def normalize_records(raw: DataFrame) -> DataFrame:
    """``id, name, address, country``, normalised; missing texts are empty. Other columns stay."""
    empty = F.lit("")
    rest = [c for c in raw.columns if c not in RAW]
    return raw.select(
        F.col("entity_id").alias("id"),
        t.normalize_name(F.coalesce("business_name", empty)).alias("name"),
        t.normalize_address(F.coalesce("business_address", empty)).alias("address"),
        t.normalize_address(F.coalesce("country", empty)).alias("country"),
        *rest,
    )


def prepare_records(records: DataFrame) -> DataFrame:
    """Adds token lists, numbers, compact texts and tagged bigrams, once per record."""
    return (
        records.withColumn("name_words", t.words(F.col("name")))
        .withColumn("address_words", t.words(F.col("address")))
        .withColumn("nums", t.numbers(F.col("address")))
        .withColumn("name_compact", t.compact(F.col("name")))
        .withColumn("address_compact", t.compact(F.col("address")))
        .withColumn("name_sorted", t.join_tokens(t.unique_words(F.col("name_words"))))
        .withColumn("name_grams", sim.tagged_bigrams(F.col("name_compact")))
        .withColumn("name_sorted_grams", sim.tagged_bigrams(F.col("name_sorted")))
        .withColumn("address_grams", sim.tagged_bigrams(F.col("address_compact")))
    )


def select_sample(records: DataFrame, mod: int, keep: int) -> DataFrame:
    """Records whose id hashes below ``keep`` modulo ``mod``."""
    if mod < 1 or keep < 1 or keep > mod:
        raise ValueError("sampling needs 1 <= keep <= mod")
    return records if keep == mod else records.where(t.hash_mod(F.col("id"), mod) < keep)
