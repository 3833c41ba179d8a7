"""Exact grouped median of a whole number, by two aggregations of the rows.

The first counts rows per (group, bucket of values); the counts tell which bucket
holds the middle ranks. The second counts single values, but only inside those
buckets. Both reduce the rows on the map side to a few counters per group, so little
is shuffled and no task ever holds a group's values: a window sees one row per bucket
of a group, or the distinct values of the one or two buckets in the middle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterstar.operators.rollup import merged, totals

# Each doubling of the value is cut into 2**BITS buckets, so a bucket is narrower than
# 1% of its values, and the positive values of a long fall into at most 7,296 buckets,
# however far they spread.
BITS = 7


def bucket_of(value: Column) -> Column:
    """A bucket number that never falls as the whole number `value` grows."""
    doublings = F.greatest(F.floor(F.log2(value)), F.lit(BITS))
    leading_bits = F.call_function("shiftright", value, (doublings - BITS).cast("int"))
    return doublings * 2 ** (BITS + 1) + leading_bits


def locate_middle(
    buckets: DataFrame, group: str, labels: Sequence[str] = (), measures: Sequence[str] = ()
) -> DataFrame:
    """One row per group: its totals and the place of its middle ranks.

    `buckets` holds one row of `totals` per (group, bucket). `labels` are columns
    that depend on the group alone. The group must not be null.
    """
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranked = buckets.withColumns(
        {
            "skipped": F.coalesce(F.sum("trips").over(earlier), F.lit(0)),
            "low_rank": F.floor((F.sum("trips").over(whole) - 1) / 2),
            "high_rank": F.floor(F.sum("trips").over(whole) / 2),
        }
    )

    def at(rank: str, column: str) -> Column:
        holds = F.expr(f"skipped <= {rank} and skipped + trips > {rank}")
        return F.max(F.when(holds, F.col(column)))

    return ranked.groupBy(group, *labels).agg(
        *merged(measures),
        at("low_rank", "bucket").alias("low_bucket"),
        at("high_rank", "bucket").alias("high_bucket"),
        at("low_rank", "skipped").alias("skipped"),
        F.max("low_rank").alias("low_rank"),
        F.max("high_rank").alias("high_rank"),
    )


def read_middle(rows: DataFrame, places: DataFrame, group: str, value: str) -> DataFrame:
    """`places` with `median_low` and `median_high`, the two middle values of each group.

    They are equal for an odd number of rows; their mean is the interpolated median.
    `rows` holds the group, the value and its bucket.
    """
    # No row lies between the two buckets, or it would hold one of the middle ranks.
    near = rows.select(group, value, "bucket").join(places, group).filter(
        "bucket between low_bucket and high_bucket"
    )
    counted = near.groupBy(*places.columns, value).agg(F.count(F.lit(1)).alias("n"))
    smaller = (
        Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    first_rank = F.col("skipped") + F.coalesce(F.sum("n").over(smaller), F.lit(0))
    return (
        counted.withColumn("first_rank", first_rank)
        .filter("first_rank <= high_rank and first_rank + n > low_rank")
        .groupBy(*places.columns)
        .agg(F.min(value).alias("median_low"), F.max(value).alias("median_high"))
    )


def exact_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    """`median_low` and `median_high` per group; rows without group or value are left out."""
    known = rows.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    known = known.withColumn("bucket", bucket_of(F.col(value))).select(group, value, "bucket")
    places = locate_middle(totals(known, [group, "bucket"]), group)
    return read_middle(known, places, group, value).select(group, "median_low", "median_high")
