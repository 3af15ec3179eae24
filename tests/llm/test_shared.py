from pyspark.sql import functions as F

from kinlink.llm import _shared


def test_models_of_one_kind_at_a_time():
    cache = _shared.worker_cache()
    cache.clear()
    assert _shared.remembered(("a", 1), lambda: "x") == "x"
    assert _shared.remembered(("a", 2), lambda: "y") == "y"
    assert _shared.remembered(("a", 1), lambda: "again") == "x"
    assert _shared.remembered(("b", 1), lambda: "z") == "z" and list(cache) == [("b", 1)]


def test_shared_folder_is_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert _shared.shared_path(spark, "x").startswith(base)
    df = spark.range(5).withColumn("v", F.lit("é"))
    again = _shared.materialize(df, "test")
    assert again.dtypes == df.dtypes and sorted(again.collect()) == sorted(df.collect())
    assert all(f.startswith(base) for f in again.inputFiles())


def test_batches_only_get_smaller(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        spark.conf.set(name, "50")
        _shared.small_batches(spark.range(1))
        assert spark.conf.get(name) == "50"
        for value in ("10000", "0"):
            spark.conf.set(name, value)
            _shared.small_batches(spark.range(1))
            assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.unset(name)
