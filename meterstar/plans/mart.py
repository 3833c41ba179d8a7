"""The star of a table directory, written once per application and then read.

The queries of `plans.reports` are meant for a written warehouse: partitioned fact,
dimensions of known size. This module gives them one for the order-line tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from meterstar.plans.etl import load_star
from meterstar.scratch import new_folder
from meterstar.sources.tables import nation_zones, order_line_trips
from meterstar.sources.warehouse import Star, read_star

# (application, tables) -> folder of the star and the schemas of its tables.
_written: dict[tuple[str, str], tuple[str, dict[str, StructType]]] = {}


def star_of(spark: SparkSession, directory: str) -> Star:
    """The written star of the tables in `directory`.

    The first call of an application writes it to a new folder, which goes when the
    application ends; later calls read that folder, or write again if it is gone.
    """
    key = (spark.sparkContext.applicationId, directory.rstrip("/"))
    if key in _written:
        try:
            return read_star(spark, *_written[key])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    root = new_folder(spark, "meterstar-star")
    star = load_star(
        order_line_trips(spark, directory), root, nation_zones(spark, directory)
    )
    _written[key] = (root, {name: df.schema for name, df in star.tables().items()})
    return star
