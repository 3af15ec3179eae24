"""Token counts with a digest cache.

A document's content digest (SHA-256 of its normalised text) and the digest of
the tokenizer version are the key of a stored count. Only distinct contents
that the cache lacks are encoded, and their counts are appended.

Normalisation maps null to the empty text and nothing else: folding case or
white space would change counts. It is a parameter for tokenizers that fold.

Texts are moved only for misses: distinct digests are found on rows of a few
bytes, and one holder of each missing digest is joined back to its text (by
broadcast where few are missing). A text that a third of all documents repeat
is one row in every step but the last join, which splits by row ranges.

The cache is a Parquet folder (``content``, ``tokenizer``, ``n_tokens``);
appends are committed whole. A cache path of None starts an empty cache in the
shared folder. Rows of lost appends or of two writers do no harm: readers take
one count for each key. Every call appends files; :func:`compact_cache` rewrites
them. Very long texts are encoded whole. Repeated rows and null ids count like any other row; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import materialize, remembered, shared_path, small_batches, text_or_empty

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Of the vocabulary's bytes and the library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0" + library.__version__.encode()).hexdigest()


def counter(path: str) -> Callable[[str], int]:
    """text -> number of tokens, without begin, end or added special tokens."""

    def build() -> Callable[[str], int]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            return lambda text: len(model.encode(text, add_bos=False, add_eos=False))
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        return lambda text: len(library.encode(text, add_special_tokens=False).ids)

    return remembered(("count", path), build)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """What is stored; nothing if there is no such folder. A folder that cannot be read is an error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def compact_cache(spark: SparkSession, path: str, into: str, files: int = 64) -> None:
    """One row for each key of the cache at ``path``, in few files, written to another folder."""
    stored = read_cache(spark, path).groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))
    stored.repartition(files, "content").write.parquet(into)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache_path: str | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[str], Column] = text_or_empty,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row."""
    spark = small_batches(docs).sparkSession
    version = tokenizer_digest(tokenizer)
    cache_path = cache_path or shared_path(spark, "token-cache")
    content = F.unhex(F.sha2(normalise(text_col).cast("binary"), 256))
    slim = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
            content.alias("content"),
        ),
        "token-slim",
    )
    holders = slim.groupBy("content").agg(F.min("doc_id").alias("holder"))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version).select("content")
    missing = materialize(holders.join(known, "content", "left_anti"), "token-missing")
    texts = docs.select(F.col(id_col).alias("holder"), normalise(text_col).alias("text"), content.alias("content"))
    texts = texts.join(
        missing.select(F.col("holder").alias("h"), F.col("content").alias("c")),
        F.col("holder").eqNullSafe(F.col("h")) & (F.col("content") == F.col("c")),
    ).select("content", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = counter(tokenizer), set()
        for batch in batches:
            digests, counts = [], []
            for digest, text in zip(batch.column(0), batch.column(1), strict=True):
                digest = digest.as_py()
                if digest not in seen:  # rows repeated with their id
                    seen.add(digest)
                    digests.append(digest)
                    counts.append(count(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array([version] * len(digests)), pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    texts.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = (
        read_cache(spark, cache_path)
        .where(F.col("tokenizer") == version)
        .join(holders, "content", "left_semi")
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    counts = materialize(counts, "token-counts")
    return slim.join(counts, "content", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
