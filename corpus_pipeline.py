"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
to the shared folder as Parquet and read again as the next stage's documents.
All stages but the last return the columns of documents, whatever they are; a
clean document passes every stage unchanged. Stages 1, 4 and 5 take null and
empty texts for empty ones and keep them; stage 2 drops them, as they are in no
language. An empty table, or empty labels or benchmark, gives what is left: a
stage that has learnt nothing rejects nothing (languages: everything).

1. toxicity: rows scored 0.5 or more by the factorization machine go.
2. language_id: rows without letters, or far from every profile, go.
3. near_duplicates: one row of each group stays (shingles of five words,
   similarity 0.8 or more), that of the smallest id; if ids are null or
   repeated, rows are judged one by one and the first of a group stays.
4. decontamination: rows that leak a benchmark item go.
5. bpe: token ids, their digest, and the digest of the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import bpe, decontaminate, langid, neardup, toxicity
from kinlink.llm._shared import materialize, small_batches

TOXIC, FAR, VOCABULARY = 0.5, 0.2, "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return small_batches(docs).where(toxicity.toxicity_column(F.col("text"), machine) < TOXIC)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.language_column(F.col("text"), langid.learn_profiles(docs))
    return small_batches(docs).where((found["lang_pred"] != "und") & (found["score"] >= FAR))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, rows = "doc_id", docs
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if not odd.isEmpty():  # ids do not tell rows apart: number the rows, once and for all
        key = next(name for name in ("row", *(f"row{k}" for k in range(len(docs.columns)))) if name not in docs.columns)
        rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    grouped = neardup.near_duplicates(rows, width=5, percent=80, id_col=key)
    gone = grouped.where("NOT kept").select(F.col("doc_id").alias(key))
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.with_digests(bpe.encode_documents(docs, path, decode=True)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: No SQL expresses the learnt stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
