import hashlib
import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_pipeline_equals_its_stages_by_hand(spark):
    """Each stage against a plain version of itself, on what the stage before kept."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from kinlink.llm import decontaminate, langid, toxicity
    from tests.llm.test_groups import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    machine = toxicity.learn(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, machine).collect()}
    kept = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] < 0.5}
    calm = docs.where(docs.doc_id.isin(*kept))
    speaker = langid.Identifier(langid.learn_profiles(calm), 400)
    kept = {i: t for i, t in kept.items() if (p := speaker.predict(t))[0] != "und" and p[1] >= 0.2}
    classes = brute_components(list(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if classes[i][1] == i}
    plain = lambda s: " ".join(w.decode() for w in decontaminate.words_of(s))
    leaked = {i for i, t in kept.items() if any(plain(x) in plain(t) for _, x in items)}
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} == set(kept) - leaked and leaked
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in found:
        ids = library.encode(kept[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].encode()).hexdigest()


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    rows = [(1, "the same old text of many words goes here", "en", "s", 3, "x"), (1, "the same old text of many words goes here", "en", "s", 3, "x")]
    rows += [(2, None, None, None, None, None), (None, "a text without an id but with words", "en", None, 1, "y"), (3, "", "en", "s", 0, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, comp string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "comp"]
        docs = spark.createDataFrame(docs.collect(), schema)
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1]  # the repeated row once


def test_rows_of_one_id_are_judged_one_by_one(spark):
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, one, 0), (1, two, 1), (None, one, 2), (None, two + " more", 3), (2, None, 4), (2, None, 5), (3, "other", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").coalesce(1)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) == [0, 1, 4, 5, 6]
    assert dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.limit(0), "").count() == 0


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0 and docs.count()
