"""Session helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("titlelabels")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    On a single machine a temporary folder takes its place; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="titlelabels-"))
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/titlelabels-{uuid4().hex}"


_scratch: ContextVar[str | None] = ContextVar("_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared one for everything kept inside the block; deleted at its end."""
    folder = shared_folder(spark)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: While a table is kept, its shuffle files go as soon as it is written, not when the driver next collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that pass between the JVM and Python at a time then: whole texts are in the memory of both.
ARROW_ROWS, MOST_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


@contextmanager
def keeping(spark: SparkSession) -> Iterator[None]:
    """Settings for writing a table that is read back; those of the session return behind it."""
    before = {key: spark.conf.get(key) for key in (DROP_SHUFFLES, ARROW_ROWS)}
    rows = int(before[ARROW_ROWS])
    try:
        spark.conf.set(DROP_SHUFFLES, "true")
        spark.conf.set(ARROW_ROWS, str(min(rows, MOST_ROWS) if rows > 0 else MOST_ROWS))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back.

    Inside :func:`scratch` they are a table in its folder; else a checkpoint, which Spark
    removes if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    spark, folder = df.sparkSession, _scratch.get()
    if folder is not None:
        path = f"{folder}/{uuid4().hex}"
        return kept_at(df, path)
    checkpoint_root(spark)
    return df.checkpoint()


def kept_at(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read back."""
    with keeping(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
