import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kinlink.llm import bpe, token_counts
from kinlink.llm.queries import op1_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "a", "  a  b\n\n c<|endoftext|> d<|endoftext|>", "a\n ", "a \nb", "a\n  b", "  a", "a\n \nb",
    "it's IT'S we've ’s", "日本語 한국어 \U00010940 ՘x", "\r\n\t a \x85\x1c x　y", "a" * 3000, "ab " * 4000, "é" * 50,
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def texts():
    r = random.Random(5)
    letters = "abcdetshinor  '\n.,019éñß日"
    return ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 90))) for _ in range(400)]


def test_encoder_equals_the_library():
    own, theirs = bpe.Bpe(BPE), library()
    for text in texts():
        want = theirs.encode(text or "", add_special_tokens=False).ids
        assert own.encode(text or "").tolist() == want, repr(text)
        assert own.decode(own.encode(text or "")) == theirs.decode(want, skip_special_tokens=False) == (text or "")


def test_bounded_memory_of_words(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 16)
    own, theirs = bpe.Bpe(BPE), library()
    text = " ".join(f"word{i}, thing{i % 7}.\nNew{i}" for i in range(300))
    assert own.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert len(own.spaced) <= 16 and len(own.spaced.old) <= 16


def test_decoding_ids_the_vocabulary_lacks():
    own = bpe.Bpe(BPE)
    import numpy as np

    assert own.decode(np.array([-1, 10**6], np.int32)) == ""
    assert own.decode(np.array([447], np.int32)) == library().decode([447], skip_special_tokens=False)


def test_query(spark, tmp_path):
    rows = [(i, x, "n_tokens") for i, x in enumerate(texts())] + [(None, "null id", "x"), (0, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(str(tmp_path / "documents.parquet"))
    theirs = library()
    found = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op1_bpe(spark, str(tmp_path)).collect())
    want = []
    for i, text, _ in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i is None, i, len(ids), digest(",".join(map(str, ids))), digest(theirs.decode(ids, skip_special_tokens=False))))
    assert found == sorted(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode_documents(bpe.encode_documents(empty, BPE), BPE).count() == 0
    assert token_counts.count_tokens(empty, PIECES).count() == 0


@pytest.mark.parametrize("path", [PIECES, BPE])
def test_counts_and_cache(spark, tmp_path, path):
    rows = [(i, x, 7) for i, x in enumerate(texts()[:60])] + [(100 + i, "a copy of one text", 7) for i in range(40)]
    rows += [(None, "null id", 7), (5, "repeated row", 7), (5, "repeated row", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    cache = str(tmp_path / "cache")
    first = token_counts.count_tokens(docs.where("doc_id < 105"), path, cache, limit=5).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count()
    before = stored.count()
    found = token_counts.count_tokens(docs, path, cache, limit=5).collect()
    again = spark.read.parquet(cache)
    assert again.count() == again.select("content").distinct().count() > before
    if path == PIECES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t, add_bos=False, add_eos=False))
    else:
        count = lambda t: len(library().encode(t, add_special_tokens=False).ids)
    want = sorted((i is None, i, len((x or "").encode()), count(x or ""), count(x or "") > 5) for i, x, _ in rows)
    assert sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == want
    assert len(first) == sum(i is not None and i < 105 for i, _, _ in rows)


def test_only_misses_are_encoded(spark, tmp_path):
    """A count planted in the cache is believed."""
    docs = spark.createDataFrame([(1, "planted"), (2, "fresh")], "doc_id long, text string")
    cache = str(tmp_path / "cache")
    key = F.unhex(F.sha2(F.lit("planted").cast("binary"), 256))
    spark.range(1).select(key.alias("content"), F.lit(token_counts.tokenizer_digest(PIECES)).alias("tokenizer"), F.lit(99).cast("long").alias("n_tokens")).write.parquet(cache)
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PIECES, cache).collect()}
    assert found == {1: 99, 2: token_counts.counter(PIECES)("fresh")}


def test_a_cache_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_bytes(b"no parquet file")
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(Exception, match="(?i)parquet"):
        token_counts.count_tokens(docs, PIECES, str(tmp_path)).collect()


def test_overlapping_writers_and_compaction(spark, tmp_path):
    """Two writers may store a content twice: counts stay single, and compaction keeps one row a key."""
    docs = spark.createDataFrame([(1, "one text"), (2, "another")], "doc_id long, text string")
    cache, other, small = (str(tmp_path / x) for x in ("cache", "other", "small"))
    want = sorted(token_counts.count_tokens(docs, PIECES, cache).collect())
    token_counts.count_tokens(docs, PIECES, other).collect()
    spark.read.parquet(other).write.mode("append").parquet(cache)
    assert spark.read.parquet(cache).count() == 4
    assert sorted(token_counts.count_tokens(docs, PIECES, cache).collect()) == want
    assert spark.read.parquet(cache).count() == 4  # nothing was missing
    token_counts.compact_cache(spark, cache, small, files=1)
    assert spark.read.parquet(small).count() == 2
    assert sorted(token_counts.count_tokens(docs, PIECES, small).collect()) == want
