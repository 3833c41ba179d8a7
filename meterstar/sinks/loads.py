"""The log of raw files that a warehouse holds, and of the load that is under way."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.sinks.swap import remove_folder
from meterstar.sources.trips import list_files
from meterstar.sources.warehouse import table_path

LOG, PENDING = "load_log", "load_pending"
# The first free task number of trip ids goes with every file: before a load, and after it.
SCHEMA = "path string, size bigint, modified timestamp, load int, block bigint"


def _read(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(table_path(root, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Load:
    """What the next load has to do."""

    number: int
    block: int  # rows with ids from here on belong to a load that did not finish
    files: list[tuple]  # path, size, modified

    @property
    def paths(self) -> list[str]:
        return [f[0] for f in self.files]


def next_load(spark: SparkSession, root: str, *paths: str) -> Load:
    """The files under `paths` that no finished load has read.

    A file that changed since it was loaded, or that went while its load was under way, fails:
    its trips can no longer be told from the others, so that a full run is needed.
    """
    listed = list_files(spark, *paths)
    log, pending = _read(spark, root, LOG), _read(spark, root, PENDING)
    if log is None:
        return Load(0, 0, [tuple(r) for r in listed.collect()])
    known = log.select("path", F.struct("size", "modified").alias("was"))
    both = listed.join(known, "path", "left")
    # Only new and changed files come to the driver; it plans their scan by name.
    found = both.filter(F.col("was").isNull() | (F.col("was") != F.struct("size", "modified"))).collect()
    changed = sorted(r.path for r in found if r.was is not None)
    if changed:
        raise ValueError(f"{len(changed)} files changed since they were loaded, run a full load: {changed[:5]}")
    files = [(r.path, r.size, r.modified) for r in found]
    last, block = log.agg(F.max("load"), F.max("block")).first()
    if pending is not None:
        unfinished = pending.join(log.select("path"), "path", "left_anti").collect()
        gone = sorted({r.path for r in unfinished} - {f[0] for f in files})
        if gone:
            raise ValueError(f"{len(gone)} files of an unfinished load are gone, run a full load: {gone[:5]}")
    return Load(last + 1, block, files)


def _rows(spark: SparkSession, load: Load, block: int) -> DataFrame:
    rows = [(*f, load.number, block) for f in load.files]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def begin(spark: SparkSession, root: str, load: Load) -> None:
    _rows(spark, load, load.block).write.mode("overwrite").parquet(table_path(root, PENDING))


def finish(spark: SparkSession, root: str, load: Load, block: int) -> None:
    """Log the load: one file, which is there or not. `block` is the next free task number."""
    _rows(spark, load, block).write.mode("append").parquet(table_path(root, LOG))
    remove_folder(spark, table_path(root, PENDING))


def forget_loads(spark: SparkSession, root: str) -> None:
    """A full run replaces what the loads had written, so their log goes."""
    for name in (LOG, PENDING):
        remove_folder(spark, table_path(root, name))
