"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can read")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dqspark-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Staged:
    """Tables written as Parquet and read back, so a lost executor repeats little.

    ``drop`` removes a table that no later step reads. The rest is removed when
    the driver's Python ends, as results may still be read until then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _folders.append((spark, self.folder))

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:04d}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def union(self, tables: list[DataFrame], schema: str) -> DataFrame:
        """All rows of staged tables of one schema, as one scan."""
        if not tables:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(tables[0].schema).parquet(*[t._staged_path for t in tables])

    def free(self) -> None:
        """Let go of shuffle files that no live table needs.

        Spark's cleaner deletes them once the driver's garbage is collected,
        which by itself may come long after the disks are full.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        delete(self.spark, df._staged_path)


@atexit.register
def _clean() -> None:
    while _folders:
        spark, folder = _folders.pop()
        try:
            if not spark.sparkContext._jsc.sc().isStopped():
                delete(spark, folder)
        except Exception:  # the session is gone, and with it the way to its folder
            return
