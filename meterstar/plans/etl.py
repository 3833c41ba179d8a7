"""The whole job: raw trips to a written star schema, a quarantine and a quality report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import quality
from meterstar.operators.audit import NOT_NULL
from meterstar.operators.derive import derive_trips
from meterstar.operators.star import fact_measures
from meterstar.sinks.loads import forget_loads
from meterstar.sinks.metrics import WriteMetrics, null_audit, split_counts
from meterstar.sinks.warehouse import write_quarantine, write_star, write_table
from meterstar.scratch import staged
from meterstar.sources.tables import nation_zones, order_line_trips
from meterstar.sources.trips import read_trips, read_zones
from meterstar.sources.warehouse import Star


@dataclass(frozen=True)
class EtlResult:
    """The written tables, the quality report, and the nulls of the fact's declared columns."""

    star: Star
    set_aside: DataFrame
    quality: DataFrame
    nulls: DataFrame


def written_counts(fact: DataFrame, set_aside: DataFrame) -> DataFrame:
    """`split_counts` from the written tables.

    Only the folder names and the row counts in the file footers are read, so no
    pass over the raw trips is spent on counting.
    """
    outcomes = fact.select(F.lit(quality.VALID).alias("outcome")).unionByName(
        set_aside.select("outcome")
    )
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(F.col("outcome") == name).alias(name)
            for name in (quality.VALID, quality.REJECTED, quality.UNDECIDED, quality.UNFIT)
        ],
    )


def load_star(
    raw: DataFrame,
    root: str,
    zones: DataFrame | None = None,
    already_by_month: bool = False,
    metrics: WriteMetrics | None = None,
) -> Star:
    """Derive, keep the valid trips and write the star."""
    valid = quality.valid_trips(derive_trips(raw))
    return write_star(fact_measures(valid), root, zones, already_by_month, metrics)


def load_quarantine(
    raw: DataFrame,
    path: str,
    composed: bool = False,
    load: int | None = None,
    metrics: WriteMetrics | None = None,
) -> DataFrame:
    """Derive, keep the other trips and write them; returned read back."""
    rows = quality.set_aside(derive_trips(raw), composed)
    write_quarantine(rows, path, load, metrics)
    return raw.sparkSession.read.schema(rows.schema).parquet(path)


def run(
    raw: DataFrame,
    warehouse: str,
    quarantine: str,
    zones: DataFrame | None = None,
    composed: bool = False,
    already_by_month: bool = False,
    stage: str | bool = False,
    sort_stage: bool = False,
) -> EtlResult:
    """Run the job on raw trips.

    `raw` is evaluated twice, once per written output, each time with that output's
    filter pushed down. If it is costlier than a file scan, or not the same each time,
    name a `stage` folder, or say True for one in the session's shared folder: it is
    written there once and both outputs read that copy; with `sort_stage` in an order in which
    the fact's read skips the row groups of rejected fares.
    """
    if stage and sort_stage:
        raw = quality.sorted_for_rules(raw)
    if stage is True:
        raw = staged(raw, "raw-trips")
    elif stage:
        write_table(raw, stage)
        raw = raw.sparkSession.read.schema(raw.schema).parquet(stage)
    of_fact, of_others = fact_metrics(), WriteMetrics(outcomes=True)
    star = load_star(raw, warehouse, zones, already_by_month, of_fact)
    set_aside = load_quarantine(raw, quarantine, composed, metrics=of_others)
    forget_loads(raw.sparkSession, warehouse)
    return result_of(star, set_aside, of_fact, of_others)


def fact_metrics() -> WriteMetrics:
    """Metrics of the fact's declared columns; the key is given by the write itself."""
    return WriteMetrics([c for c in NOT_NULL["fact_trips"] if c != "trip_id"])


def result_of(
    star: Star, set_aside: DataFrame, of_fact: WriteMetrics, of_others: WriteMetrics
) -> EtlResult:
    """The result of two writes; its counts were taken while they wrote."""
    spark = star.fact.sparkSession
    counts = split_counts(spark, of_fact, of_others)
    return EtlResult(star, set_aside, quality.quality_report(counts), null_audit(spark, of_fact))


def run_files(
    spark: SparkSession,
    raw_paths: list[str],
    zone_lookup: str,
    warehouse: str,
    quarantine: str,
    **options: bool | str,
) -> EtlResult:
    """Run the job on raw trip files and an optional zone lookup CSV."""
    zones = read_zones(spark, zone_lookup)
    return run(read_trips(spark, *raw_paths), warehouse, quarantine, zones, **options)


def run_tables(
    spark: SparkSession,
    directory: str,
    warehouse: str,
    quarantine: str,
    stage: str | bool = True,
    **options: bool,
) -> EtlResult:
    """Run the job on order-line tables; their join is evaluated once."""
    raw, zones = order_line_trips(spark, directory), nation_zones(spark, directory)
    return run(raw, warehouse, quarantine, zones, stage=stage, **options)
