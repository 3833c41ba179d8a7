"""Named queries on the star schema.

Every query takes the fact and the dimensions it joins. The fact is reduced by its
own key before the join (see `operators.rollup`), so each query is one narrow scan
of the fact, one small shuffle, and joins between small tables; Spark broadcasts a
dimension only if its size is below the session's threshold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterstar.functions import expressions as X
from meterstar.operators.median import bucket_of, locate_middle, read_middle
from meterstar.operators.rollup import merge, top, totals
from meterstar.operators.star import build_dim_geography
from meterstar.schemas import FACT_PARTITIONS

ZONE = ("zone_name", "borough")


def _avg(measure: str, name: str) -> Column:
    return X.average2(F.col(f"{measure}_sum"), F.col(f"{measure}_n")).alias(name)


def _sum(measure: str, name: str) -> Column:
    return X.round2(F.col(f"{measure}_sum")).alias(name)


def _avg_minutes(name: str) -> Column:
    mean = X.ratio(F.col("trip_duration_sum"), F.col("trip_duration_n"))
    return X.round2(X.minutes(mean)).alias(name)


def _zone_role(dim_zone: DataFrame, role: str) -> DataFrame:
    """The zone dimension as the pickup or dropoff end of a trip."""
    zones = build_dim_geography(dim_zone)
    return zones.select(
        F.col("zone_key").alias(f"{role}_key"),
        F.col("zone_name").alias(f"{role}_zone"),
        F.col("borough").alias(f"{role}_borough"),
    )


def _by_zone(fact, dim_zone, measures=(), keys=ZONE, role="pickup"):
    """Totals per zone attribute, in the pickup or the dropoff role."""
    key = f"{role}_zone_key"
    parts = totals(fact, [key], measures)
    joined = parts.join(
        build_dim_geography(dim_zone), F.col(key) == F.col("zone_key"), "inner"
    )
    return merge(joined, keys, measures)


def _by_date(fact, dim_date, measures, keys):
    parts = totals(fact, ["pickup_date_key"], measures)
    joined = parts.join(dim_date, F.col("pickup_date_key") == F.col("date_key"), "inner")
    return merge(joined, keys, measures)


def _by_payment(fact, dim_payment, measures=()):
    parts = totals(fact, ["payment_key"], measures)
    return merge(parts.join(dim_payment, "payment_key"), ["payment_type"], measures)


def _of_month(fact, dim_date, year: Column, month: Column):
    """Fact and dates of one month.

    The month is asked of the date dimension, as the query does, and of the fact's
    own partition columns, which hold the same values; only the latter lets the scan
    skip the other months' folders.
    """
    return (
        fact.filter((F.col("pickup_year") == year) & (F.col("pickup_month") == month)),
        dim_date.filter((F.col("year") == year) & (F.col("month") == month)),
    )


def in_months(months: list[tuple[int, int]]) -> Column:
    """Whether a fact row is of one of the months; the scan skips the others' folders."""
    out = F.lit(False)
    for year in sorted({y for y, _ in months}):
        own = [m for y, m in months if y == year]
        out = out | ((F.col("pickup_year") == year) & F.col("pickup_month").isin(own))
    return out


# -- warehouse queries ---------------------------------------------------------


def last_month(
    fact: DataFrame, dim_date: DataFrame, as_of: Column | dt.date | str | None = None
) -> DataFrame:
    """Trips and mean amounts of the calendar month before `as_of` (default today)."""
    start = X.previous_month(X.date_column(as_of))
    rows, dates = _of_month(fact, dim_date, F.year(start), F.month(start))
    measures = ["fare_amount", "total_amount", "tip_amount"]
    return last_month_columns(_by_date(rows, dates, measures, ["year", "month"]))


def last_month_columns(parts: DataFrame) -> DataFrame:
    return parts.select(
        "year",
        "month",
        F.col("trips").alias("total_trips"),
        _avg("fare_amount", "avg_fare_amount"),
        _avg("total_amount", "avg_total_amount"),
        _avg("tip_amount", "avg_tip_amount"),
    )


def top_zones(fact: DataFrame, dim_zone: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup zones with revenue and means."""
    measures = ["fare_amount", "trip_distance"]
    ranked = top(_by_zone(fact, dim_zone, measures), n, "trips", *ZONE)
    return ranked.select(
        *ZONE,
        F.col("trips").alias("total_trips"),
        _sum("fare_amount", "total_revenue"),
        _avg("fare_amount", "avg_fare"),
        _avg("trip_distance", "avg_distance_miles"),
    )


def borough_revenue(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Revenue per borough with its share of all boroughs, largest first.

    The window over all rows sees one row per borough.
    """
    measures = ["fare_amount", "total_amount", "trip_distance"]
    everywhere = F.sum("fare_amount_sum").over(Window.partitionBy())
    return (
        _by_zone(fact, dim_zone, measures, keys=["borough"])
        .withColumn("all_boroughs", everywhere)
        .select(
            "borough",
            F.col("trips").alias("total_trips"),
            _sum("fare_amount", "total_fare_revenue"),
            _sum("total_amount", "total_gross_revenue"),
            _avg("fare_amount", "avg_fare"),
            _avg("trip_distance", "avg_distance_miles"),
            X.percent2(F.col("fare_amount_sum"), F.col("all_boroughs")).alias("revenue_pct"),
        )
        .orderBy(F.desc("total_fare_revenue"), "borough")
    )


def _named_zones(dim_zone: DataFrame) -> DataFrame:
    """Zones with one integer `name_key` per (name, borough), which several keys may share."""
    same_name = Window.partitionBy(*ZONE)
    zones = build_dim_geography(dim_zone).filter(F.col("zone_key").isNotNull())
    return zones.select("zone_key", *ZONE, F.min("zone_key").over(same_name).alias("name_key"))


def zone_durations(
    fact: DataFrame, dim_zone: DataFrame, n: int = 20, approximate: bool = False
) -> DataFrame:
    """Mean and median minutes, distance and fare of the busiest pickup zones.

    The median is exact unless `approximate` asks for a sketch. Only the n zones of
    the result need a median, so the fact is filtered to their middle values by a
    table of n rows. Spark knows that bound from the limit, and broadcasts the table
    if it is below the session's threshold.
    """
    zones = _named_zones(dim_zone)
    duration = F.col("trip_duration")
    trips = fact.filter(duration > 0)
    labels = ["name_key", *ZONE]
    measures = ["trip_duration", "trip_distance", "fare_amount"]
    with_bucket = trips.withColumn("bucket", bucket_of(duration))
    zoned = F.col("pickup_zone_key") == F.col("zone_key")

    if approximate:
        middle = F.percentile_approx(duration, 0.5).alias("median_low")
        by_key = totals(trips, ["pickup_zone_key"], measures).join(zones, zoned)
        sketch = trips.join(zones, zoned).groupBy("name_key").agg(middle)
        leaders = top(merge(by_key, labels, measures), n, "trips", *ZONE)
        found = leaders.join(sketch, "name_key").withColumn("median_high", F.col("median_low"))
    else:
        by_bucket = totals(with_bucket, ["pickup_zone_key", "bucket"], measures)
        # Placed by name once, the few counters need no further shuffle below.
        placed = by_bucket.join(zones, zoned).repartition("name_key")
        buckets = merge(placed, [*labels, "bucket"], measures)
        leaders = top(locate_middle(buckets, "name_key", ZONE, measures), n, "trips", *ZONE)
        rows = with_bucket.join(zones.drop(*ZONE), zoned)
        found = read_middle(rows, leaders, "name_key", "trip_duration")

    low, high = X.minutes(F.col("median_low")), X.minutes(F.col("median_high"))
    return top(found, n, "trips", *ZONE).select(
        *ZONE,
        F.col("trips").alias("total_trips"),
        _avg_minutes("avg_duration_minutes"),
        X.round2(low + (high - low) * 0.5).alias("median_duration_minutes"),
        _avg("trip_distance", "avg_distance_miles"),
        _avg("fare_amount", "avg_fare"),
    )


def payment_mix(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Trips and revenue per payment type with its share of all trips, largest first."""
    measures = ["fare_amount", "tip_amount"]
    everything = F.sum("trips").over(Window.partitionBy())
    return (
        _by_payment(fact, dim_payment, measures)
        .withColumn("all_trips", everything)
        .select(
            "payment_type",
            F.col("trips").alias("total_trips"),
            _sum("fare_amount", "total_revenue"),
            _avg("fare_amount", "avg_fare"),
            _avg("tip_amount", "avg_tip"),
            X.percent2(F.col("trips"), F.col("all_trips")).alias("pct_of_trips"),
        )
        .orderBy(F.desc("total_trips"), "payment_type")
    )


def of_dates(
    fact: DataFrame, dates: DataFrame, measures: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Totals per `keys` (columns of the date dimension) of the trips on `dates`.

    Whatever `dates` was filtered by, the join on year and month as well as on the date lets
    Spark read the months that are left of it at run time, and prune the fact's folders by
    them; no query has to repeat its condition on the fact's partition columns.
    """
    parts = totals(fact, [*FACT_PARTITIONS, "pickup_date_key"], measures)
    same_day = (
        (F.col("pickup_date_key") == F.col("date_key"))
        & (F.col("pickup_year") == F.col("year"))
        & (F.col("pickup_month") == F.col("month"))
    )
    return merge(parts.join(dates, same_day), keys, measures)


def last_month_of_dates(
    fact: DataFrame, dim_date: DataFrame, as_of: Column | dt.date | str | None = None
) -> DataFrame:
    """`last_month` with the month asked of the date dimension alone."""
    start = X.previous_month(X.date_column(as_of))
    dates = dim_date.filter((F.col("year") == F.year(start)) & (F.col("month") == F.month(start)))
    measures = ["fare_amount", "total_amount", "tip_amount"]
    return last_month_columns(of_dates(fact, dates, measures, ["year", "month"]))


def quarter_summary(fact: DataFrame, dim_date: DataFrame, year: int, quarter: int) -> DataFrame:
    """The monthly summary of one quarter, which only the date dimension knows."""
    dates = dim_date.filter((F.col("year") == year) & (F.col("quarter") == quarter))
    return summary_columns(of_dates(fact, dates, SUMMARY_MEASURES, ["year", "month"]))


# -- views (unordered; the reader sorts) ---------------------------------------


SUMMARY_MEASURES = ["fare_amount", "trip_distance", "trip_duration"]


def monthly_summary(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return summary_columns(_by_date(fact, dim_date, SUMMARY_MEASURES, ["year", "month"]))


def summary_columns(parts: DataFrame) -> DataFrame:
    """The monthly summary of totals per year and month."""
    return parts.select(
        "year",
        "month",
        F.col("trips").alias("total_trips"),
        _avg("fare_amount", "avg_fare"),
        _sum("fare_amount", "total_revenue"),
        _avg("trip_distance", "avg_distance"),
        _avg_minutes("avg_duration_minutes"),
    )


def zone_revenue(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    return revenue_columns(_by_zone(fact, dim_zone, ["fare_amount"]))


def revenue_columns(parts: DataFrame) -> DataFrame:
    """The revenue view of totals per zone name and borough."""
    return parts.select(
        *ZONE,
        F.col("trips").alias("total_trips"),
        _sum("fare_amount", "total_revenue"),
        _avg("fare_amount", "avg_fare"),
    )


# -- further questions ---------------------------------------------------------


def average_fare_of_month(
    fact: DataFrame, dim_date: DataFrame, year: int, month: int
) -> DataFrame:
    rows, dates = _of_month(fact, dim_date, F.lit(year), F.lit(month))
    return _by_date(rows, dates, ["fare_amount"], []).select(_avg("fare_amount", "avg_fare"))


def month_scan(fact: DataFrame, year: int, month: int) -> DataFrame:
    """Trips and mean fare of one month from the fact alone: reads one folder."""
    one = fact.filter((F.col("pickup_year") == year) & (F.col("pickup_month") == month))
    return totals(one, [], ["fare_amount"]).select("trips", _avg("fare_amount", "avg_fare"))


def top_zones_by_revenue(fact: DataFrame, dim_zone: DataFrame, n: int = 5) -> DataFrame:
    revenue = _by_zone(fact, dim_zone, ["fare_amount"], keys=["zone_name"])
    return top(revenue, n, "fare_amount_sum", "zone_name").select(
        "zone_name", _sum("fare_amount", "revenue")
    )


def borough_totals(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    revenue = _by_zone(fact, dim_zone, ["fare_amount"], keys=["borough"])
    return revenue.select("borough", _sum("fare_amount", "total_revenue")).orderBy(
        F.desc("total_revenue"), "borough"
    )


def top_pickup_zones(fact: DataFrame, dim_zone: DataFrame, n: int = 5) -> DataFrame:
    return top(_by_zone(fact, dim_zone, keys=["zone_name"]), n, "trips", "zone_name")


def top_dropoff_zones(fact: DataFrame, dim_zone: DataFrame, n: int = 5) -> DataFrame:
    zones = _by_zone(fact, dim_zone, keys=["zone_name"], role="dropoff")
    return top(zones, n, "trips", "zone_name")


def top_zone_keys(fact: DataFrame, n: int = 5) -> DataFrame:
    """Busiest pickup zones when no lookup is at hand."""
    return top(totals(fact, ["pickup_zone_key"]), n, "trips", "pickup_zone_key")


def _routes(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Trips per pair of zone keys, with both zones' attributes."""
    return (
        totals(fact, ["pickup_zone_key", "dropoff_zone_key"])
        .join(_zone_role(dim_zone, "pickup"), F.expr("pickup_zone_key = pickup_key"))
        .join(_zone_role(dim_zone, "dropoff"), F.expr("dropoff_zone_key = dropoff_key"))
    )


def top_routes(fact: DataFrame, dim_zone: DataFrame, n: int = 10) -> DataFrame:
    ends = ["pickup_zone", "dropoff_zone"]
    return top(merge(_routes(fact, dim_zone), ends), n, "trips", *ends)


def zone_pair_count(
    fact: DataFrame, dim_zone: DataFrame, pickup: int, dropoff: int
) -> DataFrame:
    """Number of trips from one zone to another; 0 if there are none."""
    pair = (F.col("pickup_zone_key") == pickup) & (F.col("dropoff_zone_key") == dropoff)
    return _routes(fact.filter(pair), dim_zone).agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("trips")
    )


def pickups_to_zone(fact: DataFrame, dim_zone: DataFrame, dropoff: int) -> DataFrame:
    """Pickup zones of the trips that end in one zone, busiest first."""
    ending = fact.filter(F.col("dropoff_zone_key") == dropoff)
    return _by_zone(ending, dim_zone, keys=["zone_name"]).orderBy(
        F.desc("trips"), "zone_name"
    )


def trip_count(fact: DataFrame) -> DataFrame:
    return totals(fact, [])


def global_averages(fact: DataFrame) -> DataFrame:
    """Mean fare and distance over the fact; nulls when it is empty."""
    return totals(fact, [], ["fare_amount", "trip_distance"]).select(
        _avg("fare_amount", "avg_fare"), _avg("trip_distance", "avg_distance")
    )


def payment_breakdown(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    return _by_payment(fact, dim_payment).orderBy(F.desc("trips"), "payment_type")


def electronic_payments(fact: DataFrame, seed: DataFrame) -> DataFrame:
    """Trips per seeded payment type with its electronic flag."""
    parts = totals(fact, ["payment_key"]).join(seed, "payment_key")
    return merge(parts, ["payment_type", "is_electronic"])


def preview(rows: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return rows.orderBy(*order).limit(n)


def warehouse_report(
    fact: DataFrame, dim_payment: DataFrame, dim_zone: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The parts of the warehouse report; zones fall back to keys without a lookup."""
    zones = top_zone_keys(fact) if dim_zone is None else top_pickup_zones(fact, dim_zone)
    return {
        "trip_count": trip_count(fact),
        "averages": global_averages(fact),
        "top_pickup_zones": zones,
        "payment_breakdown": payment_breakdown(fact, dim_payment),
    }
