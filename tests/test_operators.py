"""Rollups, median, dimensions and audits against brute force on small rows."""

import random
import statistics
from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterstar.functions import expressions as X
from meterstar.operators import audit, dimensions, star
from meterstar.operators.median import bucket_of, exact_median
from meterstar.operators.rollup import merge, top, totals
from meterstar.plans import reports
from meterstar.plans.views import warehouse_tables


def test_round2_goes_by_decimal_text(spark):
    values = spark.createDataFrame([(1.005,), (0.125,), (-1.005,), (2.675,), (None,)], "v double")
    rounded = [r.r for r in values.select(X.round2(F.col("v")).alias("r")).collect()]
    assert rounded == [1.01, 0.13, -1.01, 2.68, None]


def test_average_that_lands_on_half_a_cent(spark):
    fares = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "fare decimal(12,2)")
    row = totals(fares, [], ["fare"]).select(
        X.average2(F.col("fare_sum"), F.col("fare_n")).alias("a")).first()
    assert row.a == 1.01


def test_previous_month(spark):
    days = spark.createDataFrame([(date(2025, 1, 31),), (date(2024, 3, 31),)], "d date")
    starts = [r.m for r in days.select(X.previous_month(F.col("d")).alias("m")).collect()]
    assert starts == [date(2024, 12, 1), date(2024, 2, 1)]


def test_merged_totals_equal_direct_totals(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(4), rng.choice(["a", "b", None]),
             rng.choice([None, Decimal(rng.randrange(1000)) / 100])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, g string, v decimal(12,2)")
    direct = totals(df, ["g"], ["v"])
    merged = merge(totals(df, ["k", "g"], ["v"]), ["g"], ["v"])
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, merged.collect()))


def test_top_breaks_ties_by_name(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 2)], "zone string, trips int")
    assert [r.zone for r in top(rows, 3, "trips", "zone").collect()] == ["a", "b", "d"]


@pytest.mark.parametrize("spread", [3, 1000, 10**6, 10**12])
def test_exact_median_against_brute_force(spark, spread):
    rng = random.Random(spread)
    groups = defaultdict(list)
    for g in range(6):
        size = [1, 2, 7, 10, 500, 501][g]
        groups[g] = [rng.randrange(1, spread) for _ in range(size)]
    # A hot value holds most of one group, and one group spans distant buckets.
    groups[6] = [5] * 900 + list(range(6, 300))
    groups[7] = [1, 10**9]
    groups[8] = [-5, 0, 0, 4]
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rows += [(None, 1), (0, None)]
    df = spark.createDataFrame(rows, "g int, v bigint")
    medians = {r.g: (r.median_low + r.median_high) / 2
               for r in exact_median(df, "g", "v").collect()}
    assert medians == {g: statistics.median(vs) for g, vs in groups.items()}


def test_buckets_never_fall_and_are_few(spark):
    edges = sorted({v for k in range(63) for v in (2**k - 1, 2**k, 2**k + 1)} | set(range(-3, 3000)))
    values = spark.createDataFrame([(v,) for v in edges], "v bigint")
    found = values.select("v", bucket_of(F.col("v")).alias("b")).orderBy("v").collect()
    numbers = [r.b for r in found]
    assert numbers == sorted(numbers)
    positive = [r.b for r in found if r.v > 0]
    assert positive[-1] - positive[0] < 15_000
    below = [r.b for r in found if r.v < 128]
    assert len(set(below)) == len(below)


def test_zone_durations_merges_zones_of_one_name(spark):
    trips = [(1, 60), (1, 120), (2, 600), (3, 60), (3, 240), (9, 60)]
    fact = spark.createDataFrame(trips, "pickup_zone_key int, trip_duration bigint").withColumns(
        {"fare_amount": F.lit(Decimal("1.00")), "trip_distance": F.lit(Decimal("2.00"))})
    zones = spark.createDataFrame(
        [(1, "Q", "Corona"), (2, "Q", "Corona"), (3, None, None)],
        "zone_key int, Borough string, Zone string")
    for approximate in (False, True):
        rows = reports.zone_durations(fact, zones, approximate=approximate).collect()
        assert [(r.zone_name, r.total_trips, r.avg_duration_minutes) for r in rows] == [
            ("Corona", 3, 4.33), (None, 2, 2.5)]
        assert rows[0].median_duration_minutes == 2.0
    assert rows[1].median_duration_minutes in (1.0, 4.0)  # the sketch does not interpolate


def test_calendar_attributes(spark):
    days = spark.createDataFrame([(date(2022, 6, 15), 2022, 6, 15, 2), (date(2022, 6, 18), 2022, 6, 18, 2)],
                                 "date_key date, year int, month int, day int, quarter int")
    wednesday, saturday = star.calendar_attributes(days).orderBy("date_key").collect()
    assert (wednesday.date_key, wednesday.month_name, wednesday.day_of_week, wednesday.is_weekend) == (
        20220615, "June", 4, False)
    assert (saturday.day_of_week, saturday.is_weekend) == (7, True)


def test_dim_payment_keeps_a_null_code_and_joins_drop_it(spark):
    trips = spark.createDataFrame([(None, "Unknown"), (1, "Credit card"), (1, "Credit card")],
                                  "payment_type int, payment_type_desc string")
    dim = star.build_dim_payment(trips)
    assert {tuple(r) for r in dim.collect()} == {(None, "Unknown"), (1, "Credit card")}
    fact = trips.withColumnRenamed("payment_type", "payment_key").drop("payment_type_desc")
    assert [tuple(r) for r in reports.payment_breakdown(fact, dim).collect()] == [("Credit card", 2)]
    orphans = audit.orphan_keys(fact, "payment_key", dim, "payment_key").collect()
    assert [(r.key, r.rows) for r in orphans] == [(None, 1)]


def test_keep_first_and_overwrite_changed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert {tuple(r) for r in dimensions.keep_first(old, new, "k").collect()} == {
        (1, "a"), (2, "b"), (3, "C")}
    assert {tuple(r) for r in dimensions.overwrite_changed(old, new, "k").collect()} == {
        (1, "a"), (2, "B"), (3, "C")}


def test_key_audits(spark):
    fact = spark.createDataFrame([(1, 7, 10), (1, 8, 10), (2, 7, None)], "id int, zone int, pay int")
    zones = spark.createDataFrame([(7,), (7,)], "zone_key int")
    pays = spark.createDataFrame([(10,)], "pay_key int")
    assert [tuple(r) for r in audit.duplicate_keys(fact, ["id"]).collect()] == [(1, 2)]
    counts = audit.primary_key_audit({"f": (fact, ["id"]), "z": (zones, ["zone_key"]), "p": (pays, ["pay_key"])})
    assert {tuple(r) for r in counts.collect()} == {("f", 1), ("z", 1), ("p", 0)}
    audited = audit.foreign_key_audit(fact, {"zone": (zones, "zone_key"), "pay": (pays, "pay_key")})
    assert {tuple(r) for r in audited.collect()} == {("zone", 1, 1, 0), ("pay", 0, 0, 1)}


def test_foreign_keys_of_an_empty_fact(spark):
    fact = spark.createDataFrame([], "zone int, pay int")
    dim = spark.createDataFrame([(7,)], "k int")
    audited = audit.foreign_key_audit(fact, {"zone": (dim, "k"), "pay": (dim, "k")})
    assert {tuple(r) for r in audited.collect()} == {("zone", 0, 0, 0), ("pay", 0, 0, 0)}


def test_declared_types(spark):
    good = [(Decimal("999999.99"), "x" * 50, 32767, Decimal("1.20"))]
    declared = {"surcharge": "DECIMAL(8,2)", "borough": "VARCHAR(50)", "riders": "SMALLINT", "fare": "DECIMAL(10,2)"}
    schema = "surcharge decimal(18,6), borough string, riders int, fare decimal(18,6)"
    bad = [(Decimal("2000000"), "x" * 60, 70000, Decimal("1.2345"))]
    for rows, fits in ((good, True), (bad, False), (good + bad, False), ([(None,) * 4], True)):
        audited = audit.type_fit_audit(spark.createDataFrame(rows, schema), declared).collect()
        assert {r.column_name: r.fits for r in audited} == dict.fromkeys(declared, fits)
        assert {r.column_name: r.warehouse_type for r in audited} == declared


def test_not_null_audit_covers_the_declared_columns(mart):
    tables = warehouse_tables(mart)
    assert set(tables) == set(audit.NOT_NULL) == set(audit.DECLARED)
    for name, columns in audit.NOT_NULL.items():
        found = audit.null_audit(tables[name], columns).collect()
        assert {r.column_name: r.nulls for r in found} == dict.fromkeys(columns, 0)


def test_merges_with_null_and_repeated_keys_are_repeatable(spark):
    old = spark.createDataFrame([(1, "a"), (None, "old")], "k int, v string")
    new = spark.createDataFrame([(None, "z"), (None, "y"), (2, "c"), (2, "b"), (1, "A")], "k int, v string")
    for merge_, want in ((dimensions.keep_first, {(1, "a"), (None, "old"), (2, "b")}),
                         (dimensions.overwrite_changed, {(1, "A"), (None, "y"), (2, "b")})):
        once = merge_(old, new, "k")
        twice = merge_(once, new, "k")
        for rows in (once.collect(), twice.collect()):
            assert len(rows) == 3 and {tuple(r) for r in rows} == want


def test_null_and_type_audits(spark):
    rows = spark.createDataFrame(
        [("x" * 300, Decimal("1.00"), 1.5, None), ("y", Decimal("123456789.00"), None, None)],
        "note string, fare decimal(12,2), d double, when_ timestamp_ntz")
    nulls = {r.column_name: r.nulls for r in audit.null_audit(rows, rows.columns).collect()}
    assert nulls == {"note": 0, "fare": 0, "d": 1, "when_": 2}
    fits = {r.column_name: r for r in audit.type_fit_audit(rows).collect()}
    assert {n: (r.warehouse_type, r.fits) for n, r in fits.items()} == {
        "note": ("VARCHAR(256)", False),
        "fare": ("DECIMAL(10,2)", False),
        "d": ("FLOAT", True),
        "when_": ("VARCHAR(256)", True),
    }
    assert (fits["note"].max_length, fits["fare"].max_abs) == (300, 123456789.0)


def test_reports_on_an_empty_fact(mart):
    none = mart.fact.limit(0)
    assert tuple(reports.global_averages(none).first()) == (None, None)
    assert reports.trip_count(none).first().trips == 0
    assert reports.zone_pair_count(none, mart.dim_zone, 1, 2).first().trips == 0
    assert reports.average_fare_of_month(none, mart.dim_date, 1998, 5).first().avg_fare is None
    assert reports.borough_revenue(none, mart.dim_zone).collect() == []
    assert reports.zone_durations(none, mart.dim_zone).collect() == []


def test_shares_add_up_and_zones_hold_every_trip(mart):
    shares = reports.payment_mix(mart.fact, mart.dim_payment).collect()
    assert abs(sum(r.pct_of_trips for r in shares) - 100) < 0.05
    boroughs = reports.borough_revenue(mart.fact, mart.dim_zone).collect()
    assert abs(sum(r.revenue_pct for r in boroughs) - 100) < 0.05
    assert sum(r.total_trips for r in boroughs) == mart.fact.count()


def test_report_parts_with_and_without_zones(mart):
    parts = reports.warehouse_report(mart.fact, mart.dim_payment, mart.dim_zone)
    assert "zone_name" in parts["top_pickup_zones"].columns
    keys = reports.warehouse_report(mart.fact, mart.dim_payment)["top_pickup_zones"]
    assert "pickup_zone_key" in keys.columns and keys.count() == 5


def test_last_month_defaults_to_today(mart):
    assert reports.last_month(mart.fact, mart.dim_date).collect() == []
