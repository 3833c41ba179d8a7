"""Every registered query against its SQL oracle on the same tables."""

import re

import pytest
from conftest import DATA
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

# The pipeline package's queries have their own tests.
QUERIES, ORACLE = (
    {k: v for k, v in named.items() if not re.match(r"op\d+_|pipeline$", k)}
    for named in (queries(), oracle_sql())
)


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, DATA), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", ["q1_last_month", "q2_top_zones", "q4_zone_duration",
                                  "fk_orphans_unchecked", "scd1_zone", "top_routes",
                                  "payment_breakdown", "quality_report"])
def test_matches_oracle_without_any_broadcast(spark, duck, settings, explained, name):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = QUERIES[name](spark, DATA)
    plan = explained(df)
    assert "Broadcast" not in plan and "Cartesian" not in plan
    assert compare(df, duck, ORACLE[name]) == []


def test_flagship(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert [r.total_trips for r in rows] == sorted((r.total_trips for r in rows), reverse=True)


def test_ordered_queries_come_out_ordered(spark):
    def column(name, key):
        return [r[key] for r in QUERIES[name](spark, DATA).collect()]

    for name, key in [("q3_borough_revenue", "total_fare_revenue"), ("q5_payment_mix", "total_trips"),
                      ("q4_zone_duration", "total_trips"), ("borough_total", "total_revenue"),
                      ("payment_breakdown", "trips"), ("vw_zone_revenue", "total_revenue")]:
        values = column(name, key)
        assert values == sorted(values, reverse=True), name
    months = [(r.year, r.month) for r in QUERIES["vw_monthly_summary"](spark, DATA).collect()]
    assert months == sorted(months)
