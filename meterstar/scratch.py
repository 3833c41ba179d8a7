"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir or, where that is unset, one in the warehouse.

    Off one machine, a warehouse on a local disk will not do, and the first has to be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local") and ":/" not in warehouse.replace("file:", ""):
        # Executors elsewhere would write to disks of their own.
        warnings.warn(f"set spark.checkpoint.dir: executors may not share {warehouse}", stacklevel=2)
    return warehouse + "/_scratch"


# The lists that want to know of new folders, in this thread of work.
_collecting: ContextVar[tuple[list[str], ...]] = ContextVar("collecting", default=())


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The list of folders made within the block, oldest first; others' folders are not in it."""
    made: list[str] = []
    token = _collecting.set((*_collecting.get(), made))
    try:
        yield made
    finally:
        _collecting.reset(token)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    # The file system object is cached per application, and deletes on its own shutdown hook.
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    for made in _collecting.get():
        made.append(path)
    return path


def read_by(df: DataFrame, paths: list[str]) -> list[str]:
    """Those of some folders that `df` still reads."""
    files = df.inputFiles()
    # Without scheme and leading slashes, which differ between the two.
    return [p for p in paths if any(p.split(":")[-1].lstrip("/") in f for f in files)]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders whose tables nothing will read any more."""
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df`, evaluated once: written to the shared folder and read back.

    The plan that made it is cut off, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
