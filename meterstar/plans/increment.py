"""Loading only the raw files that are new.

A log in the warehouse names every file that was loaded, with its size and time. A run lists
the files, and reads those the log lacks: their months of the fact are rewritten, old trips keeping
their ids and new ones getting ids above all others, and so are those months of the maintained
totals; dates and payment codes are added; the quarantine gets folders of this load's own.

A run that dies is repeated by the next one. It knows the rows of the unfinished load by their
ids, and leaves them out when it rewrites the months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import quality
from meterstar.operators.derive import derive_trips
from meterstar.operators.dimensions import keep_first
from meterstar.operators.star import (
    ROW_BITS,
    dim_date_of_fact,
    dim_payment_of_fact,
    fact_measures,
    next_block,
)
from meterstar.plans.etl import EtlResult, fact_metrics, load_quarantine, load_star, result_of
from meterstar.plans.maintained import refresh
from meterstar.plans.reports import in_months
from meterstar.schemas import FACT_PARTITIONS
from meterstar.scratch import staged
from meterstar.sinks.loads import Load, begin, finish, forget_loads, next_load
from meterstar.sinks.metrics import WriteMetrics
from meterstar.sinks.swap import remove_folder
from meterstar.sinks.warehouse import recover_warehouse, replace_table, write_fact
from meterstar.sources.trips import read_trips, read_zones
from meterstar.sources.warehouse import Star, read_star, table_path


def months_of(rows: DataFrame) -> list[tuple[int, int]]:
    """The distinct months of fact rows: one row a month comes to the driver."""
    return sorted(tuple(r) for r in rows.select(*FACT_PARTITIONS).distinct().collect())


def load_new_files(
    spark: SparkSession,
    raw_paths: list[str],
    zone_lookup: str,
    warehouse: str,
    quarantine: str,
    composed: bool = False,
) -> EtlResult | None:
    """Load the files under `raw_paths` that the warehouse has not seen; None if there are none.

    The result is that of a full run over all files, but for trip ids; its counts, nulls and
    quarantine are those of this load. Without a load log, all files are new and whatever the
    warehouse held is replaced.
    """
    recover_warehouse(spark, warehouse)
    load = next_load(spark, warehouse, *raw_paths)
    if not load.files:
        return None
    raw, zones = read_trips(spark, *load.paths), read_zones(spark, zone_lookup)
    of_fact, of_others = fact_metrics(), WriteMetrics(outcomes=True)
    if load.number == 0:
        forget_loads(spark, warehouse)
        remove_folder(spark, quarantine)
        star = load_star(raw, warehouse, zones, metrics=of_fact)
        months, rewritten = None, star.fact
    else:
        begin(spark, warehouse, load)
        star, months = _add(raw, zones, warehouse, load, of_fact)
        rewritten = star.fact.filter(in_months(months))
    set_aside = load_quarantine(raw, quarantine, composed, load.number, of_others)
    refresh(spark, warehouse, months)
    # Only the ids of the months just written are read.
    finish(spark, warehouse, load, max(load.block, next_block(rewritten)))
    return result_of(star, set_aside, of_fact, of_others)


def _add(
    raw: DataFrame, zones: DataFrame | None, root: str, load: Load, metrics: WriteMetrics
) -> tuple[Star, list[tuple[int, int]]]:
    """Bring the valid trips of `raw` into the star; also returns their months."""
    spark, old = raw.sparkSession, read_star(raw.sparkSession, root)
    # Evaluated once, and counted then: the months have to be known before they are written.
    new = fact_measures(quality.valid_trips(derive_trips(raw)))
    new = staged(metrics.observe(new.hint("rebalance")), "new-trips")
    months = months_of(new)
    if months:
        kept = old.fact.filter(in_months(months) & (F.col("trip_id") < load.block << ROW_BITS))
        write_fact(
            kept.unionByName(new, allowMissingColumns=True),
            table_path(root, "fact_trips"),
            months_only=True,
            block=load.block,
        )
    for name, dim, rows, key in [
        ("dim_date", old.dim_date, dim_date_of_fact(new), "date_key"),
        ("dim_payment", old.dim_payment, dim_payment_of_fact(new), "payment_key"),
    ]:
        replace_table(keep_first(dim, rows, key), root, name)
    if zones is not None:
        replace_table(zones, root, "dim_zone")
    else:
        remove_folder(spark, table_path(root, "dim_zone"))
    return read_star(spark, root, {"fact_trips": old.fact.schema}), months
