"""Star-schema tables: date, payment and zone dimensions around the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import expressions as X
from meterstar.schemas import FACT_COLUMNS, MONEY, RAW_TYPES

# Seed rows of the payment dimension (code, text, is_electronic).
PAYMENT_SEED = [
    (1, "Credit card", True),
    (2, "Cash", False),
    (3, "No charge", False),
    (4, "Dispute", False),
    (5, "Unknown", False),
    (6, "Voided trip", False),
]


def _dates(days: DataFrame, column: str) -> DataFrame:
    # Every calendar part is a function of the date, so the date alone is shuffled.
    day = F.col("date_key")
    return (
        days.select(F.col(column).alias("date_key"))
        .distinct()
        .select(
            "date_key",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.quarter(day).alias("quarter"),
        )
    )


def _payments(codes: DataFrame, column: str) -> DataFrame:
    return (
        codes.select(F.col(column).cast(RAW_TYPES["payment_type"]).alias("payment_key"))
        .distinct()
        .withColumn("payment_type", X.payment_text(F.col("payment_key")))
    )


def build_dim_date(trips: DataFrame) -> DataFrame:
    """One row per pickup date of derived trips."""
    return _dates(trips, "pickup_date")


def build_dim_payment(trips: DataFrame) -> DataFrame:
    """One row per payment code of derived trips; a null code keeps its row."""
    return _payments(trips, "payment_type")


def dim_date_of_fact(fact: DataFrame) -> DataFrame:
    """build_dim_date from the written fact: one narrow column instead of the raw files."""
    return _dates(fact, "pickup_date_key")


def dim_payment_of_fact(fact: DataFrame) -> DataFrame:
    return _payments(fact, "payment_key")


def build_dim_zone(lookup: DataFrame) -> DataFrame:
    return lookup.withColumnRenamed("LocationID", "zone_key")


def build_dim_geography(dim_zone: DataFrame) -> DataFrame:
    """The zone dimension under the column names the warehouse queries use."""
    return dim_zone.withColumnsRenamed({"Zone": "zone_name", "Borough": "borough"})


def calendar_attributes(dim_date: DataFrame) -> DataFrame:
    """The wide date dimension: integer key, names, weekday and weekend flag."""
    day = F.col("date")
    return dim_date.withColumnRenamed("date_key", "date").select(
        X.date_number(day).alias("date_key"),
        "date",
        "day",
        "month",
        "quarter",
        "year",
        X.month_name(day).alias("month_name"),
        X.day_of_week(day).alias("day_of_week"),
        X.is_weekend(day).alias("is_weekend"),
    )


def payment_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_SEED, "payment_key int, payment_type string, is_electronic boolean"
    )


def fact_measures(valid: DataFrame) -> DataFrame:
    """The fact layout without its surrogate key, every column in its declared type.

    Money columns missing from the input become null, so every fact has the
    same columns.
    """
    kinds = dict(valid.dtypes)
    typed = {c: F.col(c).cast(t) for c, t in RAW_TYPES.items() if kinds.get(c, t) != t}
    renamed = valid.withColumns(typed).withColumns(
        {
            "pickup_date_key": F.col("pickup_date"),
            "pickup_zone_key": F.col("PULocationID"),
            "dropoff_zone_key": F.col("DOLocationID"),
            "payment_key": F.col("payment_type"),
        }
    )
    missing = {
        name: F.lit(None).cast(MONEY)
        for name in FACT_COLUMNS[1:]
        if name not in renamed.columns
    }
    return renamed.withColumns(missing).select(*FACT_COLUMNS[1:])


# monotonically_increasing_id has the row in its lower 33 bits and the task above them.
ROW_BITS = 33


def next_block(ids: DataFrame) -> int:
    """The first task number that no `trip_id` of `ids` has used."""
    highest = ids.agg(F.max("trip_id")).first()[0]
    return 0 if highest is None else (highest >> ROW_BITS) + 1


def with_trip_id(fact: DataFrame, block: int = 0) -> DataFrame:
    """Add the surrogate key: unique, but neither dense nor the same in every run.

    A later load into the same fact starts at its `next_block`, so ids stay unique over
    loads, until 2**30 tasks have written. Rows that have a `trip_id` keep it.
    """
    key = F.monotonically_increasing_id() + F.lit(block << ROW_BITS)
    if "trip_id" in fact.columns:
        key = F.coalesce("trip_id", key)
    return fact.withColumn("trip_id", key).select(*FACT_COLUMNS)


def build_fact_trips(valid: DataFrame) -> DataFrame:
    """The fact table of derived, valid trips.

    Ids are handed out anew each time this plan runs. Write the fact and read it
    back before more than one consumer uses them.
    """
    return with_trip_id(fact_measures(valid))
