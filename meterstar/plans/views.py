"""The star under the names and keys of the warehouse schema, for `spark.sql`.

There the date key is a YYYYMMDD integer, the zone dimension is `dim_geography`, and
the payment dimension carries its electronic flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.functions import expressions as X
from meterstar.operators.audit import DECLARED
from meterstar.operators.star import (
    build_dim_geography,
    calendar_attributes,
    payment_seed,
)
from meterstar.plans.reports import monthly_summary, zone_revenue
from meterstar.schemas import FACT_PARTITIONS
from meterstar.sources.warehouse import Star


def electronic_flags(dim_payment: DataFrame) -> DataFrame:
    """The payment dimension with `is_electronic`; false for codes outside the seed."""
    flags = payment_seed(dim_payment.sparkSession).select("payment_key", "is_electronic")
    return dim_payment.join(flags, "payment_key", "left").select(
        "payment_key",
        "payment_type",
        F.coalesce("is_electronic", F.lit(False)).alias("is_electronic"),
    )


def warehouse_views(star: Star) -> dict[str, DataFrame]:
    views = {
        "fact_trips": star.fact.withColumn(
            "pickup_date_key", X.date_number(F.col("pickup_date_key"))
        ),
        "dim_date": calendar_attributes(star.dim_date),
        "dim_payment": electronic_flags(star.dim_payment),
        "vw_monthly_summary": monthly_summary(star.fact, star.dim_date),
    }
    if star.dim_zone is not None:
        views["dim_geography"] = build_dim_geography(star.dim_zone)
        views["vw_zone_revenue"] = zone_revenue(star.fact, star.dim_zone)
    return views


def register_views(star: Star) -> list[str]:
    """Register the views for SQL in the session of the star; returns their names."""
    views = warehouse_views(star)
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return sorted(views)


def warehouse_tables(star: Star) -> dict[str, DataFrame]:
    """The tables that the warehouse declares, with its columns and key types."""
    views = warehouse_views(star)
    tables = {name: views[name] for name in DECLARED if name in views}
    return tables | {"fact_trips": tables["fact_trips"].drop(*FACT_PARTITIONS)}
