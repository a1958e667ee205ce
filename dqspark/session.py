"""Spark session and shared scratch tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Input bytes that one shuffle partition should stand for.
PARTITION_BYTES = 128 * 1024 * 1024


def get_spark(app: str = "dqspark", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are designed for.

    Adaptive execution coalesces partitions and splits skewed joins at run
    time. It can only merge what a shuffle has made, so ``input_bytes``, the
    size of the largest input, sets how many partitions a shuffle starts with.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # No Python call sites per Column: halves the time to build long reports.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(max(200, -(-input_bytes // PARTITION_BYTES))))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would not be readable by the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can read")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dqspark-"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Owner of the tables staged while it is active; leaving it deletes those, and only those.

    ``with Scratch(spark): ...`` around a job that builds its frames and writes
    its results inside. Scopes nest: a table belongs to the innermost one.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._before = None

    def __enter__(self) -> Scratch:
        self._before = _active.set(self)
        return self

    def __exit__(self, *_) -> None:
        _active.reset(self._before)
        self.release()

    def path(self) -> str:
        self.paths.append(f"{scratch_dir(self.spark).rstrip('/')}/dqspark-{uuid.uuid4().hex}")
        return self.paths[-1]

    def release(self) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = hadoop.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


_active: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a durable Parquet table: it survives lost executors,
    pins values that a re-run could change (partition ids), stays columnar, and
    has a true size, so joins on it are planned from facts. The table lives as
    long as the active ``Scratch``; without one, as a lazy result may still read
    it, until the driver's Python ends.
    """
    spark = df.sparkSession
    owner = _active.get()
    if owner is None:
        owner = Scratch(spark)
        atexit.register(_release_if_alive, owner)
    path = owner.path()
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _release_if_alive(owner: Scratch) -> None:
    try:
        if not owner.spark.sparkContext._jsc.sc().isStopped():
            owner.release()
    except Exception:  # the session is gone, and with it the way to its folder
        return
