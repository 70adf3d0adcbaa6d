"""Cutting lineage so that an intermediate result survives the loss of executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Deletes the shuffles of a statement when it ends.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_CLEANING = threading.Lock()
_writing: dict[SparkSession, tuple[int, str | None]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the session names; a scratch folder only for an unset local run."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING, None)
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"Set {CHECKPOINT_SETTING} to a folder shared by all executors.")
    folder = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is written inside are deleted with the end of the writing, not when the driver's memory is swept."""
    with _CLEANING:
        count, before = _writing.get(spark) or (0, spark.conf.get(CLEANUP_SETTING, None))
        _writing[spark] = count + 1, before
        spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        with _CLEANING:
            count, before = _writing.pop(spark)
            if count > 1:
                _writing[spark] = count - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP_SETTING)
            else:
                spark.conf.set(CLEANUP_SETTING, before)


def durable(df: DataFrame, **options: str | int) -> DataFrame:
    """Write the result once as a table in the shared folder and continue from there.

    A written table is computed once, keeps column pruning and filter pushdown for the
    passes that follow, and does not depend on any executor. ``options`` are those of its files.
    """
    return durable_parts([df], **options)


def durable_parts(frames: Iterable[DataFrame], **options: str | int) -> DataFrame:
    """The union of some frames, at least one and all of one schema, written one after the other: the shuffles of one are gone before the next."""
    path = None
    for df in frames:
        path = path or f"{shared_folder(df.sparkSession).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
        with _shuffles_deleted(df.sparkSession):
            df.write.mode("append").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete tables written by `durable` that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        folder = shared_folder(spark).rstrip("/").removeprefix("file:").lstrip("/")
        for file in frame.inputFiles()[:1]:
            parent = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if f"{folder}/plumbline/" in parent.toString():
                parent.getFileSystem(conf).delete(parent, True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can read; one that is gone already is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


SMALL_ROWS = 100_000


def kept(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A result of schema size, computed now and held as a local table.

    For tables with a few rows per column, pair of columns or model that several later
    steps read. A larger result is an error, so nothing data-sized passes the driver.
    """
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError(f"The result has more than {rows} rows; write it as a table instead.")
    return df.sparkSession.createDataFrame(found, df.schema)
