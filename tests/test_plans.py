"""What the plans must look like to hold at scale."""

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from __spark_entry__ import queries
from meterstar.operators import quality
from meterstar.operators.derive import derive_trips
from meterstar.plans import reports
from meterstar.sources.tables import order_line_trips

# The pipeline package's queries have their own tests.
QUERIES = {k: v for k, v in queries().items() if not re.match(r"op\d+_|pipeline$", k)}


def scans(plan):
    return re.findall(r"\(\d+\) Scan parquet.*?ReadSchema: \S+", plan, flags=re.S)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_runs_python_or_pairs_everything(spark, explained, name):
    plan = explained(QUERIES[name](spark, DATA))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_month_filters_prune_folders(mart, explained):
    for df in (reports.month_scan(mart.fact, 1998, 3),
               reports.last_month(mart.fact, mart.dim_date, "1998-04-15"),
               reports.average_fare_of_month(mart.fact, mart.dim_date, 1998, 5)):
        fact = next(s for s in scans(explained(df)) if "fact_trips" in s)
        assert "PartitionFilters: [isnotnull(pickup_year" in fact
        assert re.search(r"pickup_month#\d+ = \d", fact)


def test_default_last_month_prunes_folders_too(mart, explained):
    plan = explained(reports.last_month(mart.fact, mart.dim_date))
    assert "PartitionFilters: [isnotnull(pickup_year" in plan


def test_dimension_joins_broadcast_the_small_written_dimension(mart, explained):
    for df in (reports.top_zones(mart.fact, mart.dim_zone),
               reports.payment_mix(mart.fact, mart.dim_payment),
               reports.monthly_summary(mart.fact, mart.dim_date)):
        plan = explained(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fact_is_reduced_before_any_join_or_shuffle(mart, explained):
    plan = explained(reports.top_zones(mart.fact, mart.dim_zone))
    tree = plan.split("(1) Scan")[0]
    lines = [line for line in tree.splitlines() if "Scan parquet" in line or "HashAggregate" in line
             or "Exchange" in line or "Join" in line]
    fact = next(i for i, line in enumerate(lines) if "Scan parquet" in line)
    assert "HashAggregate" in lines[fact - 1]


def test_zone_query_reads_only_its_columns(mart, explained):
    fact = next(s for s in scans(explained(reports.top_zones(mart.fact, mart.dim_zone)))
                if "fact_trips" in s)
    read = re.search(r"ReadSchema: struct<(.*)>", fact).group(1)
    assert {c.split(":")[0] for c in re.split(r",(?![^(]*\))", read)} == {
        "pickup_zone_key", "fare_amount", "trip_distance"}


def test_zone_pair_filter_reaches_the_files(mart, explained):
    plan = explained(reports.zone_pair_count(mart.fact, mart.dim_zone, 3, 7))
    assert "EqualTo(pickup_zone_key,3)" in plan and "EqualTo(dropoff_zone_key,7)" in plan


def test_top_k_keeps_k_rows_per_task(mart, explained):
    for df in (reports.top_zones(mart.fact, mart.dim_zone),
               reports.zone_durations(mart.fact, mart.dim_zone),
               reports.top_routes(mart.fact, mart.dim_zone)):
        assert "TakeOrderedAndProject" in explained(df)


def test_median_scans_the_fact_twice_and_shuffles_only_counts(mart, explained):
    plan = explained(reports.zone_durations(mart.fact, mart.dim_zone))
    assert len([s for s in scans(plan) if "fact_trips" in s]) == 2
    # The leaders' table is small enough to broadcast for 20 rows, not for 10 million.
    assert "SortMergeJoin" not in plan
    many = explained(reports.zone_durations(mart.fact, mart.dim_zone, n=10_000_000))
    assert "SortMergeJoin" in many


def test_orders_and_lines_are_never_broadcast(spark, explained):
    plan = explained(quality.split_counts(derive_trips(order_line_trips(spark, DATA))))
    assert "SortMergeJoin" in plan


def test_date_filter_on_raw_trips_reaches_the_files(spark, explained):
    trips = derive_trips(order_line_trips(spark, DATA))
    day = F.lit("1998-03-01").cast("date")
    plan = explained(trips.filter(F.col("pickup_date") >= day))
    assert "GreaterThanOrEqual(o_orderdate,1998-03-01" in plan


def test_a_hot_order_key_is_split(spark, settings, explained, tmp_path):
    """A third of the lines on one order: AQE splits the partition, no row is lost."""
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet")
    hot = lines.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_orderkey")).cast("bigint"))
    hot.repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("orders", "customer", "supplier"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
    )
    df = order_line_trips(spark, str(tmp_path)).groupBy("l_orderkey").count()
    rows = {r.l_orderkey: r["count"] for r in df.collect()}
    assert "skewed" in explained(df).split("Initial Plan")[0] or "SortMergeJoin(skew=true)" in explained(df)
    keys = {r.o_orderkey for r in spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey").collect()}
    expected = hot.groupBy("l_orderkey").count().collect()
    assert rows == {r.l_orderkey: r["count"] for r in expected if r.l_orderkey in keys}
