"""Validity rules: split trips three ways, name the failed rules, count the outcomes.

A rule over a null operand is neither true nor false, so a trip can be valid,
rejected or undecided. The rules see the values of the source. A trip that no rule
rejects can still hold a value that the fact's type cannot: it is unfit. The four sets
are disjoint and together hold every trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.functions import expressions as X
from meterstar.schemas import MONEY, RAW_TYPES

# The constant reason text, and the rule names of the composed reason.
CONSTANT_REASON = "Failed quality checks: duration<=0 OR fare<0 OR distance<0"
TIME_INVERSION = "time_inversion"
NEGATIVE_FARE = "negative_fare"
NEGATIVE_DISTANCE = "negative_distance"

VALID, REJECTED, UNDECIDED, UNFIT = "valid", "rejected", "undecided", "unfit"
UNFIT_REASON = "Value does not fit: "


def is_valid() -> Column:
    return (
        (F.col("trip_duration") > 0)
        & (F.col("fare_amount") >= 0)
        & (F.col("trip_distance") >= 0)
    )


def _cannot_hold(field: T.StructField) -> Column | None:
    """Whether the fact's type cannot hold a column's value; None if it always can."""
    kind, target, value = field.dataType, RAW_TYPES[field.name], F.col(field.name)
    lost = value.isNotNull() & value.try_cast(target).isNull()
    if target == MONEY:
        small = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) or (
            isinstance(kind, T.DecimalType) and kind.precision - kind.scale <= 12
        )
        return None if small else lost
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return None
    # A fraction in a whole number is lost as well.
    return lost | (value != F.floor(value)) if not isinstance(kind, T.LongType) else lost


def sorted_for_rules(raw: DataFrame) -> DataFrame:
    """Raw trips in an order in which the rules skip row groups of their files.

    The rules on fare and distance are stated on the columns as they are in the files, so they
    reach the scan as filters on each row group's smallest and largest value. Sorted within the
    writing tasks, rejected fares fill row groups of their own. Each task sorts what it has
    anyway; nothing is shuffled.
    """
    return raw.sortWithinPartitions(*[c for c in ("fare_amount", "trip_distance") if c in raw.columns])


def unfit_columns(trips: DataFrame) -> Column | None:
    """Comma-joined names of the columns whose value the fact cannot hold, '' if there is
    none; None if the types say that every value fits."""
    checks = {
        f.name: _cannot_hold(f) for f in trips.schema.fields if f.name in RAW_TYPES
    }
    names = [F.when(check, F.lit(name)) for name, check in checks.items() if check is not None]
    if "unread" in trips.columns:
        names.append(F.array_join(F.map_keys("unread"), ","))
    if not names:
        return None
    return F.array_join(F.array_compact(F.array(*[F.nullif(n, F.lit("")) for n in names])), ",")


def outcome(trips: DataFrame) -> Column:
    """Which of the four sets a trip is in."""
    names = unfit_columns(trips)
    rejected = F.when(~is_valid(), REJECTED)
    if names is not None:
        rejected = rejected.when(names != "", UNFIT)
    return rejected.when(is_valid().isNull(), UNDECIDED).otherwise(VALID)


def valid_trips(trips: DataFrame) -> DataFrame:
    names = unfit_columns(trips)
    valid = trips.filter(is_valid())
    return valid if names is None else valid.filter(names == "")


def failed_rules() -> Column:
    """Comma-joined names of the rules a trip definitely fails."""
    return F.concat_ws(
        ",",
        F.when(F.col("trip_duration") <= 0, TIME_INVERSION),
        F.when(F.col("fare_amount") < 0, NEGATIVE_FARE),
        F.when(F.col("trip_distance") < 0, NEGATIVE_DISTANCE),
    )


def rejected_trips(trips: DataFrame, composed: bool = False) -> DataFrame:
    """Trips that fail a rule, with the constant reason or the failed rules' names."""
    reason = failed_rules() if composed else F.lit(CONSTANT_REASON)
    return trips.filter(~is_valid()).withColumn("rejection_reason", reason)


def undecided_trips(trips: DataFrame) -> DataFrame:
    """Trips that fail no rule but miss a value some rule needs."""
    names = unfit_columns(trips)
    undecided = trips.filter(is_valid().isNull())
    return undecided if names is None else undecided.filter(names == "")


def unfit_trips(trips: DataFrame) -> DataFrame:
    """Trips that fail no rule but hold a value that the fact cannot, with that reason."""
    names = unfit_columns(trips)
    reason = F.concat(F.lit(UNFIT_REASON), F.lit("") if names is None else names)
    return trips.filter(outcome(trips) == UNFIT).withColumn("rejection_reason", reason)


def valid_and_rejected(
    trips: DataFrame, composed: bool = False
) -> tuple[DataFrame, DataFrame]:
    return valid_trips(trips), rejected_trips(trips, composed)


def set_aside(trips: DataFrame, composed: bool = False) -> DataFrame:
    """Rejected, unfit and undecided trips from one scan, told apart by `outcome`.

    They keep the values of the source. The reason is null for undecided trips.
    """
    reason = failed_rules() if composed else F.lit(CONSTANT_REASON)
    names, state = unfit_columns(trips), F.col("outcome")
    wanted = ~is_valid() | is_valid().isNull()
    why = F.when(state == REJECTED, reason)
    if names is not None:
        wanted = wanted | (names != "")
        why = why.when(state == UNFIT, F.concat(F.lit(UNFIT_REASON), names))
    return (
        trips.filter(wanted)
        .withColumn("outcome", outcome(trips))
        .withColumn("rejection_reason", why)
    )


def split_counts(trips: DataFrame) -> DataFrame:
    """One row: total, valid, rejected, undecided, unfit, from one pass.

    Each trip's outcome is worked out once; grouped by it, a task hands over four rows.
    """
    sizes = trips.groupBy(outcome(trips).alias("outcome")).agg(F.count(F.lit(1)).alias("trips"))

    def of(condition: Column | bool = True) -> Column:
        return F.coalesce(F.sum(F.when(F.lit(True) & condition, F.col("trips"))), F.lit(0))

    return sizes.agg(
        of().alias("total"),
        *[of(F.col("outcome") == name).alias(name) for name in (VALID, REJECTED, UNDECIDED, UNFIT)],
    )


def quality_report(counts: DataFrame) -> DataFrame:
    """Counts plus the valid and rejected shares; 0.0 when there are no trips."""
    total = F.col("total")
    return counts.select(
        "total",
        VALID,
        REJECTED,
        UNDECIDED,
        UNFIT,
        F.coalesce(X.percent2(F.col(VALID), total), F.lit(0.0)).alias("pct_valid"),
        F.coalesce(X.percent2(F.col(REJECTED), total), F.lit(0.0)).alias("pct_rejected"),
    )
