"""Validity rules, reasons and counts on edge rows."""

from datetime import datetime

import pytest

from meterstar.operators import quality
from meterstar.operators.derive import derive_trips, payment_description, trip_duration

EDGE_SCHEMA = "case string, trip_duration bigint, fare_amount decimal(12,2), trip_distance decimal(12,2)"
EDGE = [
    ("plain", 10, 1, 1, "valid", None),
    ("zero duration", 0, 1, 1, "rejected", "time_inversion"),
    ("negative fare and null duration", None, -1, 1, "rejected", "negative_fare"),
    ("null duration", None, 1, 1, "undecided", None),
    ("null fare", 10, None, 1, "undecided", None),
    ("negative distance", 10, 1, -1, "rejected", "negative_distance"),
    ("all fail", -5, -1, -1, "rejected", "time_inversion,negative_fare,negative_distance"),
    ("free ride over no distance", 10, 0, 0, "valid", None),
]


@pytest.fixture(scope="module")
def edge(spark):
    from decimal import Decimal

    rows = [(c, d, f if f is None else Decimal(f), t if t is None else Decimal(t))
            for c, d, f, t, *_ in EDGE]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def names(df):
    return {r["case"] for r in df.collect()}


def expected(outcome):
    return {row[0] for row in EDGE if row[4] == outcome}


def test_three_way_split(edge):
    valid, rejected = quality.valid_and_rejected(edge)
    assert names(valid) == expected("valid")
    assert names(rejected) == expected("rejected")
    assert names(quality.undecided_trips(edge)) == expected("undecided")


def test_reasons(edge):
    constant = {r.rejection_reason for r in quality.rejected_trips(edge).collect()}
    assert constant == {"Failed quality checks: duration<=0 OR fare<0 OR distance<0"}
    composed = {r["case"]: r.rejection_reason for r in quality.rejected_trips(edge, composed=True).collect()}
    assert composed == {row[0]: row[5] for row in EDGE if row[4] == "rejected"}


def test_set_aside_holds_both_outcomes(edge):
    rows = {r["case"]: (r.outcome, r.rejection_reason)
            for r in quality.set_aside(edge, composed=True).collect()}
    assert rows == {row[0]: (row[4], row[5]) for row in EDGE if row[4] != "valid"}


def test_counts_and_report(edge):
    counts = quality.split_counts(edge)
    assert counts.first().asDict() == {"total": 8, "valid": 2, "rejected": 4, "undecided": 2, "unfit": 0}
    report = quality.quality_report(counts).first()
    assert (report.pct_valid, report.pct_rejected) == (25.0, 50.0)


def test_report_of_no_trips(edge):
    report = quality.quality_report(quality.split_counts(edge.limit(0))).first()
    assert report.asDict() == {"total": 0, "valid": 0, "rejected": 0, "undecided": 0, "unfit": 0,
                               "pct_valid": 0.0, "pct_rejected": 0.0}


def test_payment_codes(spark):
    codes = spark.createDataFrame([(c,) for c in (None, 1, 2, 3, 4, 5, 6, 9)], "payment_type int")
    text = {r.payment_type: r.payment_type_desc for r in payment_description(codes).collect()}
    assert text == {None: "Unknown", 1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute",
                    5: "Unknown", 6: "Unknown", 9: "Unknown"}


@pytest.mark.parametrize(
    "pickup, dropoff, seconds",
    [
        (datetime(2025, 1, 1, 0, 0, 0, 100000), datetime(2025, 1, 1, 0, 0, 0, 900000), 0),
        (datetime(2025, 1, 1, 0, 0, 0, 900000), datetime(2025, 1, 1, 0, 0, 1, 100000), 1),
        (datetime(2025, 3, 9, 1, 30), datetime(2025, 3, 9, 3, 30), 7200),
        (datetime(2025, 1, 1), None, None),
    ],
)
def test_duration_counts_wall_clock_seconds(spark, settings, pickup, dropoff, seconds):
    settings(spark__sql__session__timeZone="America/New_York")
    trips = spark.createDataFrame(
        [(pickup, dropoff)],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz",
    )
    assert trip_duration(trips).first().trip_duration == seconds


def test_derived_columns_in_order(spark):
    trips = spark.createDataFrame(
        [(datetime(2022, 6, 15, 23, 59), datetime(2022, 6, 16), 1)],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, payment_type int",
    )
    derived = derive_trips(trips)
    assert derived.columns[3:] == ["trip_duration", "pickup_date", "pickup_year", "pickup_month",
                                   "payment_type_desc"]
    row = derived.first()
    assert (row.trip_duration, str(row.pickup_date), row.pickup_year, row.pickup_month) == (
        60, "2022-06-15", 2022, 6)


def test_split_over_every_mix_of_nulls_and_signs(spark):
    """All 64 combinations against three-valued logic in Python."""
    from decimal import Decimal
    from itertools import product

    values = (None, -1, 0, 1)
    rows = [(f"{d},{f},{t}", d, f if f is None else Decimal(f), t if t is None else Decimal(t))
            for d, f, t in product(values, repeat=3)]

    def outcome(d, f, t):
        rules = [None if d is None else d > 0, None if f is None else f >= 0, None if t is None else t >= 0]
        return "rejected" if False in rules else "undecided" if None in rules else "valid"

    trips = spark.createDataFrame(rows, EDGE_SCHEMA)
    want = {name: {r[0] for r in rows if outcome(*r[1:]) == name}
            for name in ("valid", "rejected", "undecided")}
    assert names(quality.valid_trips(trips)) == want["valid"]
    assert names(quality.rejected_trips(trips)) == want["rejected"]
    assert names(quality.undecided_trips(trips)) == want["undecided"]
    aside = quality.set_aside(trips).collect()
    assert {(r["case"], r.outcome) for r in aside} == {
        (case, name) for name in ("rejected", "undecided") for case in want[name]}
    counts = quality.split_counts(trips).first().asDict()
    assert counts == {"total": 64, "unfit": 0} | {name: len(cases) for name, cases in want.items()}
