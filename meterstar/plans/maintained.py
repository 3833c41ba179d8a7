"""The two views kept up to date: totals per date and zone beside the fact.

`fact_totals` has one row per month, date and pickup zone, with sums and counts that add up. Both
views are small joins over it, and after a load only the loaded months' rows are renewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators.rollup import merge, totals
from meterstar.operators.star import build_dim_geography
from meterstar.plans.reports import (
    SUMMARY_MEASURES,
    ZONE,
    in_months,
    revenue_columns,
    summary_columns,
)
from meterstar.schemas import FACT_PARTITIONS
from meterstar.sinks.swap import (
    NEXT,
    PARTS,
    exists,
    recover_parts,
    recover_table,
    remove_folder,
    swap_in,
    swap_parts,
)
from meterstar.sources.warehouse import read_table, table_path

TOTALS = "fact_totals"
KEYS = [*FACT_PARTITIONS, "pickup_date_key", "pickup_zone_key"]


def refresh(spark: SparkSession, root: str, months: list[tuple[int, int]] | None = None) -> None:
    """Renew the totals of some months of the written fact, or of all.

    Months that are named must be all that changed since the last refresh; if there was none,
    all are computed. A month that lost its last trip loses its folder.
    """
    table = table_path(root, TOTALS)
    recover_table(spark, table)
    recover_parts(spark, table)
    fact = read_table(spark, root, "fact_trips")
    if months is None or not exists(spark, table):
        _write(totals(fact, KEYS, SUMMARY_MEASURES), table + NEXT)
        swap_in(spark, table)
    elif months:
        own = totals(fact.filter(in_months(months)), KEYS, SUMMARY_MEASURES)
        _write(own, table + PARTS)
        renewed = swap_parts(spark, table)
        for year, month in months:
            part = f"pickup_year={year}/pickup_month={month}"
            if part not in renewed:
                remove_folder(spark, f"{table}/{part}")


def _write(rows: DataFrame, path: str) -> None:
    # Few rows a month: one file each.
    rows.repartition(*FACT_PARTITIONS).write.mode("overwrite").partitionBy(*FACT_PARTITIONS).parquet(path)


def monthly_summary(spark: SparkSession, root: str) -> DataFrame:
    """`reports.monthly_summary` from the maintained totals."""
    days = merge(read_table(spark, root, TOTALS), ["pickup_date_key"], SUMMARY_MEASURES)
    dates = read_table(spark, root, "dim_date")
    joined = days.join(dates, F.col("pickup_date_key") == F.col("date_key"))
    return summary_columns(merge(joined, ["year", "month"], SUMMARY_MEASURES))


def zone_revenue(spark: SparkSession, root: str) -> DataFrame:
    """`reports.zone_revenue` from the maintained totals."""
    by_zone = merge(read_table(spark, root, TOTALS), ["pickup_zone_key"], ["fare_amount"])
    zones = build_dim_geography(read_table(spark, root, "dim_zone"))
    joined = by_zone.join(zones, F.col("pickup_zone_key") == F.col("zone_key"))
    return revenue_columns(merge(joined, ZONE, ["fare_amount"]))
