"""Trips and zones out of order-line tables.

One order line stands for one trip: the order date is the pickup, the ship date
the dropoff, the customer's and the supplier's nations are the zones. A returned
line is a refund (negative fare) and quantity 1 means an unknown distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.schemas import MONEY


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def order_line_trips(spark: SparkSession, directory: str) -> DataFrame:
    """Raw trips.

    The customer is joined to the orders and not to the lines, so the largest table
    is shuffled at most once per key. Orders and lines both grow with the data, hence
    the merge hint: neither is ever broadcast, and AQE splits a hot order's partition.
    Customer and supplier carry no hint: Spark broadcasts one only while its size is
    below the session's threshold, and sort-merges beyond it.
    """
    orders = table(spark, directory, "orders").join(
        table(spark, directory, "customer"), F.expr("o_custkey = c_custkey")
    )
    lines = table(spark, directory, "lineitem").join(
        orders.hint("merge"), F.expr("l_orderkey = o_orderkey")
    )
    trips = lines.join(table(spark, directory, "supplier"), F.expr("l_suppkey = s_suppkey"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    fare = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    return trips.select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        F.col("l_linenumber").alias("passenger_count"),
        fare.cast(MONEY).alias("fare_amount"),
        F.nullif("l_quantity", F.lit(1.0)).cast(MONEY).alias("trip_distance"),
        (price * discount).cast(MONEY).alias("tip_amount"),
        (price * tax).cast(MONEY).alias("toll_amount"),
        (price * (1 - discount + tax)).cast(MONEY).alias("total_amount"),
    )


def nation_zones(spark: SparkSession, directory: str) -> DataFrame:
    """The zone dimension: nations as zones, regions as boroughs."""
    return (
        table(spark, directory, "nation")
        .join(table(spark, directory, "region"), F.expr("n_regionkey = r_regionkey"))
        .select(
            F.col("n_nationkey").alias("zone_key"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
        )
    )
