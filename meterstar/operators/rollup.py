"""Two-step grouped totals.

The fact is first reduced by its own integer key (partial aggregation on the map
side, so a hot key costs each task one row), and only those few rows meet a
dimension. Neither the fact nor a hot key is ever shuffled for a dimension join,
whatever the dimension's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals(rows: DataFrame, keys: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Per key: `trips`, and for each measure m its `m_sum` and non-null count `m_n`."""
    parts = [F.count(F.lit(1)).alias("trips")]
    for name in measures:
        parts += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]
    return rows.groupBy(*keys).agg(*parts)


def merged(measures: Sequence[str] = ()) -> list[Column]:
    """Aggregates that add up rows of `totals` and keep their shape."""
    columns = ["trips"]
    for name in measures:
        columns += [f"{name}_sum", f"{name}_n"]
    return [F.sum(c).alias(c) for c in columns]


def merge(parts: DataFrame, keys: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Rows of `totals` added up under coarser keys."""
    return parts.groupBy(*keys).agg(*merged(measures))


def top(rows: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The n largest rows; `ties` orders equal values so the result is stable."""
    return rows.orderBy(F.desc(by), *ties).limit(n)
