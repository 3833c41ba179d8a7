"""SQL on the registered views gives what the query functions give."""

import pytest

from meterstar.plans import reports
from meterstar.plans.views import register_views


@pytest.fixture(scope="module")
def names(mart):
    return register_views(mart)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_names(names):
    assert names == ["dim_date", "dim_geography", "dim_payment", "fact_trips",
                     "vw_monthly_summary", "vw_zone_revenue"]


def test_monthly_sql(spark, mart, names):
    got = spark.sql("""
        select year, month, count(*) as trips, sum(fare_amount) as fares
        from fact_trips join dim_date on pickup_date_key = date_key
        group by year, month having year = 1998 and month = 3""").first()
    want = reports.last_month(mart.fact, mart.dim_date, "1998-04-15").first()
    assert (got.year, got.month, got.trips) == (want.year, want.month, want.total_trips)
    assert round(float(got.fares) / got.trips, 2) == pytest.approx(want.avg_fare_amount, abs=0.01)


def test_median_sql(spark, mart, names):
    got = spark.sql("""
        select zone_name, borough, count(*) as total_trips,
               percentile_cont(0.5) within group (order by trip_duration / 60.0) as median
        from fact_trips join dim_geography on pickup_zone_key = zone_key
        group by zone_name, borough order by total_trips desc, zone_name limit 20""")
    want = reports.zone_durations(mart.fact, mart.dim_zone)
    assert [(r.zone_name, r.total_trips, round(float(r.median), 2)) for r in got.collect()] == [
        (r.zone_name, r.total_trips, r.median_duration_minutes) for r in want.collect()]


def test_shares_sql(spark, mart, names):
    got = spark.sql("""
        select p.payment_type, count(*) * 100.0 / sum(count(*)) over () as share
        from fact_trips f join dim_payment p on f.payment_key = p.payment_key
        group by p.payment_type""")
    want = {r.payment_type: r.pct_of_trips for r in reports.payment_mix(mart.fact, mart.dim_payment).collect()}
    assert {r.payment_type: pytest.approx(float(r.share), abs=0.006) for r in got.collect()} == want


def test_electronic_and_calendar_columns(spark, names):
    assert rows(spark.sql("select payment_type from dim_payment where is_electronic")) == [("Credit card",)]
    weekend = spark.sql("select distinct day_of_week from dim_date where is_weekend order by 1")
    assert rows(weekend) == [(1,), (7,)]


def test_views_equal_the_functions(spark, mart, names):
    assert sorted(rows(spark.table("vw_monthly_summary"))) == sorted(
        rows(reports.monthly_summary(mart.fact, mart.dim_date)))
    assert sorted(rows(spark.table("vw_zone_revenue"))) == sorted(
        rows(reports.zone_revenue(mart.fact, mart.dim_zone)))
