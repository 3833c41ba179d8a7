"""Reader for the warehouse folder: one Parquet folder per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


TABLES = ("dim_date", "dim_payment", "dim_zone", "fact_trips")


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_payment: DataFrame
    dim_zone: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        """The tables present, under their warehouse names, fact last."""
        named = {
            "dim_date": self.dim_date,
            "dim_payment": self.dim_payment,
            "dim_zone": self.dim_zone,
            "fact_trips": self.fact,
        }
        return {name: df for name, df in named.items() if df is not None}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, name))


def read_star(
    spark: SparkSession, root: str, schemas: dict[str, StructType] | None = None
) -> Star:
    """All tables of a warehouse; the zone table is optional.

    A stated schema spares the look into that table's file footers, and lets a fact
    without any files be read.
    """
    schemas = schemas or {}

    def read(name: str) -> DataFrame:
        return read_table(spark, root, name, schemas.get(name))

    try:
        zones = read("dim_zone")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        zones = None
    return Star(
        fact=read("fact_trips"),
        dim_date=read("dim_date"),
        dim_payment=read("dim_payment"),
        dim_zone=zones,
    )
