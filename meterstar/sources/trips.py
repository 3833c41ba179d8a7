"""Readers for raw trip files and the zone lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators.star import build_dim_zone
from meterstar.schemas import RAW_TYPES, ZONE_COLUMNS


def _readable(trips: DataFrame) -> DataFrame:
    """Numbers that the files hold as text, parsed.

    A text that is no number stays, by column, in the map `unread`; its trip is unfit.
    """
    texts = [
        f.name for f in trips.schema.fields
        if f.name in RAW_TYPES and isinstance(f.dataType, T.StringType)
    ]
    if not texts:
        return trips
    number = {c: F.col(c).try_cast("double") for c in texts}
    kept = [x for c in texts for x in (F.lit(c), F.when(number[c].isNull(), F.col(c)))]
    unread = F.map_filter(F.create_map(*kept), lambda _, text: text.isNotNull())
    return trips.withColumn("unread", unread).withColumns(number)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """path, size and modified of the files under globs or folders; no file is read."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The columns of some files, read from all their footers in tasks; None if types clash."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _by_schema(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files dealt into groups that agree on the types of common columns.

    Files whose types clash are halved until each part agrees. Files of one age stand together
    in the order of their names, so that a change of types costs a few halvings, each one job
    over the footers; parts that agree then join, so there is one scan for each set of types.
    """
    groups: list[tuple[T.StructType, list[str]]] = []
    waiting = [files]
    while waiting:
        part = waiting.pop()
        schema = _merged_schema(spark, part)
        if schema is None:
            half = len(part) // 2
            waiting += [part[half:], part[:half]]
            continue
        kinds = {f.name: f.dataType for f in schema}
        for i, (other, own) in enumerate(groups):
            if all(kinds.get(f.name, f.dataType) == f.dataType for f in other):
                more = [f for f in schema if f.name not in other.names]
                groups[i] = T.StructType([*other.fields, *more]), own + part
                break
        else:
            groups.append((schema, part))
    return groups


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan raw trips; every column of the files is kept, with the files' values.

    A path may be a glob. Columns that only some files have are null in the others. Files may
    differ in column types (an int column in one year, double in the next, text in a third):
    there is one scan for each set of types, and their union takes the wider type.
    """
    schema = _merged_schema(spark, paths)
    if schema is not None:
        return _readable(spark.read.schema(schema).parquet(*paths))
    # Only names come to the driver, which plans the scans by them.
    files = [r.path for r in list_files(spark, *paths).select("path").distinct().orderBy("path").collect()]
    groups = [
        _readable(spark.read.schema(schema).parquet(*own))
        for schema, own in _by_schema(spark, files)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """The zone dimension from a lookup CSV, or None if there is no such file.

    Columns go by their header names, in any order; absent ones but the key are null, and
    others are left out. A lookup without the key fails here, before anything is written.
    """
    try:
        lookup = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if "LocationID" not in lookup.columns:
        raise ValueError(f"{path} has no column LocationID, only {lookup.columns}")
    return build_dim_zone(
        lookup.select(
            *[
                (F.col(c).try_cast(kind) if c in lookup.columns else F.lit(None).cast(kind)).alias(c)
                for c, kind in ZONE_COLUMNS.items()
            ]
        )
    )
