"""Derived trip columns: one projection, no shuffle, pushed into the scan stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.functions import expressions as X


def trip_duration(trips: DataFrame) -> DataFrame:
    """Whole seconds from pickup to dropoff; each side is floored first."""
    seconds = F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp(
        "tpep_pickup_datetime"
    )
    return trips.withColumn("trip_duration", seconds)


def pickup_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "pickup_date": F.to_date("tpep_pickup_datetime"),
            "pickup_year": F.year("tpep_pickup_datetime"),
            "pickup_month": F.month("tpep_pickup_datetime"),
        }
    )


def payment_description(trips: DataFrame) -> DataFrame:
    return trips.withColumn("payment_type_desc", X.payment_text(F.col("payment_type")))


def derive_trips(trips: DataFrame) -> DataFrame:
    """All derived columns of a raw trip table."""
    return payment_description(pickup_calendar(trip_duration(trips)))
