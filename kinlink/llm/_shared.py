"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage travel to the Python workers by value, so that
# executors need no copy of the repository on their own path.
cloudpickle.register_pickle_by_value(sys.modules["kinlink.llm"])

_FALLBACK_DIR: list[str] = []


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    name = "_kinlink_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def remembered(key: tuple, build: Callable):
    """What ``build`` made for ``key`` in this Python worker.

    Models of another kind (the key's first part) are dropped first: a worker
    serves one operator after the other and must not hold all their models.
    """
    cache = worker_cache()
    if key not in cache:
        others = [k for k in cache if isinstance(k, tuple) and k[0] != key[0]]
        for k in others:
            del cache[k]
        if others:
            gc.collect()
        cache[key] = build()
    return cache[key]


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Lower the session's Arrow batches to ``rows`` where nothing smaller is set.

    Whole texts travel in these batches, so the default of 10,000 rows would
    decide the memory of executors and workers.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= rows:
        conf.set(name, str(rows))
    return df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Read from ``spark.checkpoint.dir``; a folder of our own is made only where
    that is unset and Spark runs on one machine, as in tests. On a cluster a
    missing setting is an error: a machine's own folder would lose rows.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _FALLBACK_DIR:
        _FALLBACK_DIR.append("file://" + tempfile.mkdtemp(prefix="kinlink-"))
    return _FALLBACK_DIR[0]


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/kinlink/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread of a file, not a rerun.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one call, in a folder of their own that ``clear`` deletes."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.count = spark, shared_path(spark, "scratch"), 0

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """As :func:`materialize`, until ``clear``."""
        self.count += 1
        path = f"{self.root}/{self.count}-{tag}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def crc_of_id(id_col: str) -> Column:
    """crc32 of the id written as text (unsigned, as BIGINT); null stays null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))
