"""Dimension maintenance.

Both operators return a new dimension. Spark cannot overwrite files the same plan
reads; `sinks.warehouse.replace_table` writes the result beside the old table first.

Keys compare null-safe: a null key is a key like any other. Of incoming rows with one
key, the row that sorts first by its other columns counts, so a merge is repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key that sorts first by its other columns, nulls first."""
    others = [c for c in rows.columns if c != key]
    if not others:
        return rows.distinct()
    least = rows.groupBy(key).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(*[F.col(c) if c == key else F.col(f"_least.{c}") for c in rows.columns])


def _without(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The rows whose key `other` does not have."""
    keys = other.select(F.col(key).alias("_key"))
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")


def keep_first(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Type 0: add rows whose key is absent; rows already present never change."""
    return _without(one_per_key(incoming, key), existing, key).unionByName(existing)


def overwrite_changed(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Type 1: an incoming row replaces the row of the same key."""
    return _without(existing, incoming, key).unionByName(one_per_key(incoming, key))
