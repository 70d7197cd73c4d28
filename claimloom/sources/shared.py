"""The folder for data that one job writes and another reads."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of a method. Java never compiles a larger one, it is interpreted (``HugeMethodLimit``).
METHOD_BYTES = 8000
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def in_compiled_methods(spark: SparkSession) -> None:
    """Let Spark cut the code of wide projections into methods that Java compiles.

    Whole-stage code is one method per stage, a wide table's too. Above the limit Spark projects by
    small methods instead; rows are the same. A limit that the user has set stays.
    """
    if METHOD_LIMIT not in spark.conf.getAll:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


@contextmanager
def setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    """The session with this setting in here; it is put back after."""
    old = spark.conf.getAll.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


@contextmanager
def open_writers(spark: SparkSession, number: int) -> Iterator[None]:
    """Writes in here keep a file open for each of up to ``number`` folders and do not sort their
    rows by folder; a task that meets more folders sorts the rest. Settings are put back after."""
    with setting(spark, OPEN_WRITERS, number):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Actions in here remove their shuffle files from the executors' disks as soon as they end.

    Else the files stay until the driver happens to collect its garbage.
    """
    with setting(spark, DROP_SHUFFLES, "true"):
        yield


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Unset on one machine (tests), a temporary folder takes its place. Unset on a cluster is an
    error: a machine-local folder would lose rows there.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='run-')}"
    spark.conf.set(SETTING, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the same rows for every reader."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
