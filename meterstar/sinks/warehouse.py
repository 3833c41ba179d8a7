"""Writers for the star schema and the quarantine folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators.quality import REJECTED
from meterstar.operators.star import (
    dim_date_of_fact,
    dim_payment_of_fact,
    next_block,
    with_trip_id,
)
from meterstar.schemas import FACT_PARTITIONS
from meterstar.sinks.metrics import WriteMetrics
from meterstar.sinks.swap import (
    NEXT,
    PARTS,
    recover_parts,
    recover_table,
    remove_folder,
    swap_in,
    swap_parts,
)
from meterstar.sources.warehouse import TABLES, Star, read_star, read_table, table_path


def write_table(rows: DataFrame, path: str) -> None:
    """Replace a folder; the rows must not be read from that same folder."""
    rows.write.mode("overwrite").parquet(path)


def replace_table(rows: DataFrame, root: str, name: str) -> DataFrame:
    """Replace a warehouse table by rows that may be computed from it.

    The rows are written beside the table and swapped in (see `sinks.swap`): readers find the
    old rows until the new ones are complete, and a run that dies at any step loses neither.
    """
    spark, table = rows.sparkSession, table_path(root, name)
    recover_table(spark, table)
    write_table(rows, table + NEXT)
    swap_in(spark, table)
    return read_table(spark, root, name, rows.schema)


def recover_warehouse(spark: SparkSession, root: str) -> None:
    """Bring every table that a dead run left between two folders back under its name."""
    for name in TABLES:
        recover_table(spark, table_path(root, name))
    recover_parts(spark, table_path(root, "fact_trips"))


def _first_block(spark: SparkSession, path: str) -> int:
    """Where the ids of another load into the fact at `path` start."""
    try:
        return next_block(spark.read.parquet(path).select("trip_id"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0


def write_fact(
    measures: DataFrame,
    path: str,
    months_only: bool = False,
    already_by_month: bool = False,
    block: int | None = None,
    metrics: WriteMetrics | None = None,
) -> None:
    """Write the fact in year and month folders, sorted by date inside each file.

    A rebalancing shuffle brings the rows of a month together, and AQE splits a
    large month over as many tasks as its bytes need, so neither tiny files nor a
    one-task month arise. `already_by_month` skips that shuffle for input whose
    files already follow the months. Ids are given after the shuffle, by the tasks
    that write: a repeated upstream task then cannot give out an id twice. `metrics` are
    taken there, too.

    `months_only` replaces only the months present in `measures`, which may be computed from
    the fact itself: they are written beside it and swapped in one by one, and a run that died
    in between goes on where it stopped (`sinks.swap`). Ids then start at the task number
    `block`, by default above all that the fact at `path` has, which one pass over its ids finds.
    """
    spark = measures.sparkSession
    if months_only:
        recover_parts(spark, path)
        block = _first_block(spark, path) if block is None else block
    rows = measures if already_by_month else measures.hint("rebalance", *FACT_PARTITIONS)
    if metrics is not None:
        rows = metrics.observe(rows)
    rows = rows.sortWithinPartitions(*FACT_PARTITIONS, "pickup_date_key")
    (
        with_trip_id(rows, block or 0)
        .write.mode("overwrite")
        .partitionBy(*FACT_PARTITIONS)
        .parquet(path + PARTS if months_only else path)
    )
    if months_only:
        swap_parts(spark, path)


def write_quarantine(
    set_aside: DataFrame, path: str, load: int | None = None, metrics: WriteMetrics | None = None
) -> None:
    """Write trips that are not valid, in one folder per outcome.

    With a `load`, in one per outcome and load, and those of other loads stay.
    """
    rows, folders = set_aside, ["outcome"]
    if load is not None:
        rows, folders = rows.withColumn("load", F.lit(load)), ["outcome", "load"]
    rows = rows.hint("rebalance", "outcome")
    if metrics is not None:
        rows = metrics.observe(rows)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if load is None else "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def rejected_path(quarantine: str) -> str:
    """The folder of a quarantine that holds the rejected trips alone."""
    return f"{quarantine.rstrip('/')}/outcome={REJECTED}"


def write_star(
    measures: DataFrame,
    root: str,
    zones: DataFrame | None = None,
    already_by_month: bool = False,
    metrics: WriteMetrics | None = None,
) -> Star:
    """Write fact and dimensions, and return them read back.

    The fact is written first; the date and payment dimensions come from the
    written copy, so the raw data are read once for the whole star and every later
    reader sees the same trip ids. Every table is written beside the one it replaces and
    swapped in when all of them are complete. Without `zones`, a zone table of an earlier
    run is removed: the warehouse holds what this run wrote, nothing older.
    """
    spark = measures.sparkSession
    recover_warehouse(spark, root)
    fresh = table_path(root, "fact_trips") + NEXT
    write_fact(measures, fresh, already_by_month=already_by_month, metrics=metrics)
    # The schema is stated, so an empty fact reads back as well.
    fact = spark.read.schema(with_trip_id(measures).schema).parquet(fresh)
    tables = {"dim_date": dim_date_of_fact(fact), "dim_payment": dim_payment_of_fact(fact)}
    if zones is not None:
        tables["dim_zone"] = zones
    for name, rows in tables.items():
        write_table(rows, table_path(root, name) + NEXT)
    for name in (*tables, "fact_trips"):
        swap_in(spark, table_path(root, name))
    if zones is None:
        remove_folder(spark, table_path(root, "dim_zone"))
    return read_star(spark, root, {"fact_trips": fact.schema})
