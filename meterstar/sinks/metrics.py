"""Counts and nulls of what is written, taken while it is written.

The rows pass an observation on their way to the files, so no scan of the raw trips or of the
written table is spent on counting. It stands behind the shuffle, in the stage that writes:
there Spark adds up each task once, however often it was tried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import quality


class WriteMetrics:
    """Of one write: all rows, the nulls of some columns and, by `outcome`, the rows of each."""

    def __init__(self, null_columns: Sequence[str] = (), outcomes: bool = False):
        self.null_columns = list(null_columns)
        self.outcomes = [quality.REJECTED, quality.UNDECIDED, quality.UNFIT] if outcomes else []
        self._seen: Observation | None = None

    def observe(self, rows: DataFrame) -> DataFrame:
        """`rows`, which count when they are written; to be called once per write."""
        self._seen = Observation()
        return rows.observe(
            self._seen,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls of {c}") for c in self.null_columns],
            *[F.count_if(F.col("outcome") == o).alias(o) for o in self.outcomes],
        )

    def get(self, name: str) -> int:
        """A metric by name; 0 if the plan had no rows to pass, and so no observation either."""
        return (self._seen.get if self._seen else {}).get(name) or 0


def split_counts(spark: SparkSession, fact: WriteMetrics, set_aside: WriteMetrics) -> DataFrame:
    """`quality.split_counts` from the writes of the fact and of the quarantine."""
    valid, others = fact.get("rows"), [set_aside.get(o) for o in set_aside.outcomes]
    names = ["total", quality.VALID, *set_aside.outcomes]
    return spark.createDataFrame(
        [(valid + sum(others), valid, *others)], ", ".join(f"{n} bigint" for n in names)
    )


def null_audit(spark: SparkSession, written: WriteMetrics) -> DataFrame:
    """`audit.null_audit` of the columns that were observed."""
    return spark.createDataFrame(
        [(c, written.get(f"nulls of {c}")) for c in written.null_columns],
        "column_name string, nulls bigint",
    )
