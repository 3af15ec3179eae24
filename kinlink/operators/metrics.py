"""Labels, splits and entity-level scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

#: 0 (all), 0.100 to 0.995, and the next number above 1 (none).
THRESHOLDS = [0.0, *[0.1 + i * 0.005 for i in range(180)], math.nextafter(1.0, 2.0)]


def explode_truth(truth: DataFrame) -> DataFrame:
    """``ref_id, target_id`` of each true link."""
    return truth.select("ref_id", F.explode("target_ids").alias("target_id")).distinct()


def label_pairs(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Adds ``label``: 1 where the pair is a true link."""
    marked = links.select("ref_id", "target_id", F.lit(1).alias("label"))
    return pairs.join(marked, ["ref_id", "target_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def entity_table(refs: DataFrame, links: DataFrame) -> DataFrame:
    """``ref_id, country, n_true, fold, split`` of every reference, also those with no link."""
    return entity_table_of_counts(refs, links.groupBy("ref_id").agg(F.count(F.lit(1)).alias("n_true")))


def entity_table_of_counts(refs: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``entity_table``, from ``ref_id, n_true`` of the references that have links."""
    fold = t.fold_of(F.col("ref_id"))
    return (
        refs.select(F.col("id").alias("ref_id"), "country")
        .join(counts, "ref_id", "left")
        .withColumn("n_true", F.coalesce("n_true", F.lit(0)))
        .withColumn("fold", fold)
        .withColumn("split", t.split_of(F.col("fold")))
    )


def entity_score(n_correct: Column, n_predicted: Column, n_true: Column) -> Column:
    """F0.5 of one entity; 1 if nothing is true and nothing predicted."""
    below = n_predicted + F.lit(0.25) * n_true
    return (
        F.when((n_true == 0) & (n_predicted == 0), 1.0)
        .when(below == 0, 0.0)
        .otherwise(F.lit(1.25) * n_correct / below)
    )


def score_entities(entities: DataFrame, scored: DataFrame, threshold: float | Column) -> DataFrame:
    """Per entity: candidates, retrieved, predicted and correct pairs, and the score.

    ``scored`` has ``ref_id, label, probability``.
    """
    chosen = F.col("probability") >= threshold
    counts = scored.groupBy("ref_id").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.sum("label").alias("n_retrieved"),
        F.count_if(chosen).alias("n_predicted"),
        F.count_if(chosen & (F.col("label") == 1)).alias("n_correct"),
    )
    added = ["n_candidates", "n_retrieved", "n_predicted", "n_correct"]
    joined = entities.join(counts, "ref_id", "left").na.fill(0, added)
    return joined.withColumn("score", entity_score(F.col("n_correct"), F.col("n_predicted"), F.col("n_true")))


def threshold_scores(entities: DataFrame, scored: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """``threshold, score``: the macro score of the tuning split at each threshold.

    Each entity has at most ``k`` candidates, so an entity's probabilities are a
    bounded list; the thresholds are a short constant array. Scores of all
    thresholds are computed inside the row, without a product of tables.
    """
    grid = THRESHOLDS if thresholds is None else thresholds
    lists = scored.groupBy("ref_id").agg(F.collect_list(F.struct("probability", "label")).alias("pairs"))
    tuning = entities.where(F.col("split") == "tuning").join(lists, "ref_id", "left")
    pairs = F.coalesce("pairs", F.array().cast("array<struct<probability:double,label:int>>"))
    tuning = tuning.withColumn("pairs", pairs).withColumn("threshold", F.explode(F.lit(grid)))
    chosen = F.filter("pairs", lambda p: p["probability"] >= F.col("threshold"))
    correct = F.size(F.filter(chosen, lambda p: p["label"] == 1))
    score = entity_score(correct, F.size(chosen), F.col("n_true"))
    return tuning.select("threshold", score.alias("score")).groupBy("threshold").agg(F.avg("score").alias("score"))


def choose_threshold(entities: DataFrame, scored: DataFrame) -> DataFrame:
    """One row ``threshold, score``: the best of the tuning split, ties to the highest threshold."""
    best = F.max(F.struct("score", "threshold")).alias("best")
    return threshold_scores(entities, scored).agg(best).select("best.threshold", "best.score")


def describe(scores: DataFrame, *by: str) -> DataFrame:
    """The report of a group of entities: macro score, precision, recalls, averages."""
    ratio = lambda a, b, empty: F.when(F.sum(b) > 0, F.sum(a) / F.sum(b)).otherwise(empty)
    return scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.avg("score").alias("macro_f05"),
        ratio("n_correct", "n_predicted", 0.0).alias("pair_precision"),
        ratio("n_correct", "n_true", 1.0).alias("pair_recall"),
        ratio("n_retrieved", "n_true", 1.0).alias("blocking_recall"),
        F.avg("n_candidates").alias("average_candidates"),
        F.count_if(F.col("n_true") == 0).alias("singletons"),
    )


def imperfect(scores: DataFrame, limit: int = 40) -> DataFrame:
    """``ref_id, country`` of the first imperfect holdout entities."""
    worst = scores.where((F.col("split") == "holdout") & (F.col("score") < 1)).orderBy("ref_id").limit(limit)
    return worst.select("ref_id", "country")


def error_examples(scores: DataFrame, scored: DataFrame, links: DataFrame, threshold: float, limit: int = 40) -> DataFrame:
    """False positives, false negatives and unretrieved links of the first imperfect holdout entities."""
    worst = imperfect(scores, limit)
    found = scored.join(worst, "ref_id", "left_semi").groupBy("ref_id").agg(
        F.collect_set("target_id").alias("candidates"),
        F.collect_set(F.when(F.col("probability") >= threshold, F.col("target_id"))).alias("predicted"),
    )
    true = links.join(worst, "ref_id", "left_semi").groupBy("ref_id").agg(F.collect_set("target_id").alias("truth"))
    none = F.array().cast("array<string>")
    both = worst.join(found, "ref_id", "left").join(true, "ref_id", "left")
    for c in ("candidates", "predicted", "truth"):
        both = both.withColumn(c, F.coalesce(c, none))
    less = lambda a, b: F.array_sort(F.array_except(a, b))
    return both.select(
        "ref_id",
        "country",
        less("predicted", "truth").alias("false_positive_ids"),
        less("truth", "predicted").alias("false_negative_ids"),
        less("truth", "candidates").alias("unretrieved_true_ids"),
    )
