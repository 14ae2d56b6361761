"""Tables written half way, so that lineage ends in files every executor can read."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`. Where that is unset in local mode, as in tests, one of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="waybill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Landing:
    """Tables of one run of an operator below one shared folder; it goes when the session ends, or table by table."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, shared_folder(spark, name)
        self._fs, root = self._path(self.root)
        root = self._fs.makeQualified(root)
        self.root = root.toString()  # a whole address: tasks that write files themselves know no default file system
        self._fs.deleteOnExit(root)

    def _path(self, path: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def land(self, df: DataFrame, name: str, **options) -> DataFrame:
        df.write.options(**options).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def close(self) -> None:
        """Delete all tables of the run; for callers that have written what they took from them."""
        fs, root = self._path(self.root)
        fs.delete(root, True)

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._path(f"{self.root}/{name}")
            fs.delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Marks a written table of few narrow columns for broadcast if it has at most `rows` rows; else Spark shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    store = sys.modules.setdefault("_waybill_llm_store", types.ModuleType("_waybill_llm_store"))
    return store.__dict__.setdefault(name, {})
