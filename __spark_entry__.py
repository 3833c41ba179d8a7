"""

Operators on raw trips are evaluated straight from the given tables. Queries on the
star schema read the star that `star_of` derives from the same tables and writes
once per application.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import audit, dimensions, quality, star
from meterstar.operators.derive import (
    derive_trips,
    payment_description,
    pickup_calendar,
    trip_duration,
)
from meterstar.plans import etl, maintained, reports
from meterstar.plans.increment import load_new_files
from meterstar.plans.mart import star_of
from meterstar.plans.views import warehouse_tables
from meterstar.schemas import FACT_PARTITIONS
from meterstar.scratch import new_folder
from meterstar.sinks import metrics
from meterstar.sinks.warehouse import write_fact, write_star
from meterstar.sources.tables import nation_zones, order_line_trips, table
from meterstar.sources.warehouse import read_star

# The pipeline package registers its own queries where it can be imported.
try:
    from meterstar.llm import registry as llm
except ImportError:
    llm = None

AS_OF = "1998-04-15"
YEAR, MONTH = 1998, 5
PREVIEW_ORDER = [
    "pickup_date_key", "pickup_zone_key", "dropoff_zone_key", "payment_key", "fare_amount",
    "trip_duration", "passenger_count", "tip_amount", "toll_amount", "total_amount",
]
PRUNED_YEAR, PRUNED_MONTH = 1998, 3
FROM_ZONE, TO_ZONE = 3, 7

RAW_AUDITED = ["tpep_dropoff_datetime", "payment_type", "fare_amount", "trip_distance", "trip_duration"]


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, the common ground of both engines' results."""
    doubles = {f.name: F.col(f.name).cast("double") for f in rows.schema.fields
               if f.dataType.typeName() == "decimal"}
    return rows.withColumns(doubles)


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_trips(order_line_trips(spark, sf_dir))


def _split(trips: DataFrame, *more: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "trip_duration", "fare_amount", "trip_distance"]
    return _plain(trips.select(*columns, *more))


def _primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = star_of(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    return audit.primary_key_audit(
        {
            "dim_date": (mart.dim_date, ["date_key"]),
            "dim_payment": (mart.dim_payment, ["payment_key"]),
            "dim_zone": (mart.dim_zone, ["zone_key"]),
            "fact_trips": (mart.fact, ["trip_id"]),
            "order_lines": (lines, ["l_orderkey", "l_linenumber"]),
        }
    )


def _foreign_keys(rows: DataFrame, mart, check=audit.foreign_key_audit) -> DataFrame:
    return check(
        rows,
        {
            "pickup_date_key": (mart.dim_date, "date_key"),
            "pickup_zone_key": (mart.dim_zone, "zone_key"),
            "dropoff_zone_key": (mart.dim_zone, "zone_key"),
            "payment_key": (mart.dim_payment, "payment_key"),
        },
    )


def _renamed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later zone delivery: keys moved by 20, so 5 keys change names and 20 are new."""
    return nation_zones(spark, sf_dir).withColumn("zone_key", F.col("zone_key") + 20)


def _roundtrip(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("pickup_year", "pickup_month")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").cast("double").alias("revenue"))
    )


def _too_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of source types: fares and zones scaled until some fit no fact column."""
    return _trips(spark, sf_dir).withColumns(
        {
            "fare_amount": F.col("fare_amount").cast("double") * 2e7,
            "PULocationID": F.col("PULocationID") + F.col("l_orderkey") * 100_000,
            "DOLocationID": F.col("DOLocationID") + F.col("l_linenumber") / 2,
        }
    )


def _unfit(trips: DataFrame) -> DataFrame:
    return (
        quality.set_aside(trips)
        .filter(F.col("outcome") == quality.UNFIT)
        .groupBy("rejection_reason")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fares"))
    )


def _after_reload(s) -> DataFrame:
    """The fact after a month was loaded a second time and another one for the first."""
    spark, path = s.fact.sparkSession, f"{new_folder(s.fact.sparkSession, 'reloaded')}/fact"
    measures = s.fact.drop("trip_id")
    again, late = "pickup_year = 1998 and pickup_month = 3", "pickup_year = 1997 and pickup_month = 1"
    write_fact(measures.filter(f"not ({late})"), path)
    write_fact(measures.filter(again), path, months_only=True)
    write_fact(measures.filter(late), path, months_only=True)
    return (
        spark.read.parquet(path)
        .groupBy("pickup_year")
        .agg(F.count(F.lit(1)).alias("trips"), F.count_distinct("trip_id").alias("ids"))
    )


def _written_while_counting(spark: SparkSession, sf_dir: str):
    """The metrics of a job's two writes."""
    trips = _trips(spark, sf_dir)
    root, of_fact, of_others = new_folder(spark, "counted"), etl.fact_metrics(), metrics.WriteMetrics(outcomes=True)
    write_fact(star.fact_measures(quality.valid_trips(trips)), f"{root}/fact", metrics=of_fact)
    etl.load_quarantine(order_line_trips(spark, sf_dir), f"{root}/set-aside", metrics=of_others)
    return of_fact, of_others


def _after_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after two loads of raw files, the second of those that were new."""
    folder, third = new_folder(spark, "raw-files"), F.col("l_orderkey") % 3
    raw = order_line_trips(spark, sf_dir)
    place = [f"{folder}/raw/*", f"{folder}/no-zones.csv", f"{folder}/warehouse", f"{folder}/set-aside"]
    for name, part in (("first", third < 2), ("second", third == 2)):
        raw.filter(part).write.parquet(f"{folder}/raw/{name}")
        load_new_files(spark, [place[0]], *place[1:])
    return (
        read_star(spark, place[2]).fact.groupBy(*FACT_PARTITIONS)
        .agg(F.count(F.lit(1)).alias("trips"), F.count_distinct("trip_id").alias("ids"),
             F.sum("fare_amount").cast("double").alias("revenue"))
    )


def _kept_totals(s) -> str:
    """A warehouse whose totals were made without one month, and renewed for it alone."""
    spark = s.fact.sparkSession
    root, measures = new_folder(spark, "kept-totals"), s.fact.drop("trip_id")
    late = (F.col("pickup_year") == YEAR) & (F.col("pickup_month") == MONTH)
    write_star(measures.filter(~late), root, s.dim_zone)
    maintained.refresh(spark, root)
    write_fact(measures.filter(late), f"{root}/fact_trips", months_only=True)
    s.dim_date.write.mode("overwrite").parquet(f"{root}/dim_date")
    maintained.refresh(spark, root, [(YEAR, MONTH)])
    return root


def _planted_duplicates(s) -> DataFrame:
    """What the audit by intervals finds in a fact that holds one month's trips twice."""
    path = f"{new_folder(s.fact.sparkSession, 'twice')}/fact"
    write_fact(s.fact.drop("trip_id"), path)
    fact = s.fact.sparkSession.read.parquet(path)
    twice = fact.filter((F.col("pickup_year") == YEAR) & (F.col("pickup_month") == MONTH))
    twice.write.mode("append").partitionBy(*FACT_PARTITIONS).parquet(path)
    found = audit.duplicate_ids(s.fact.sparkSession.read.parquet(path))
    return found.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                     F.coalesce(F.sum("rows"), F.lit(0)).alias("trips"))


def _null_keys(trips: DataFrame) -> DataFrame:
    """Fact measures with a null payment key for every third line number."""
    third = F.col("l_linenumber") % 3 == 0
    return star.fact_measures(
        trips.withColumn("payment_type", F.when(~third, F.col("payment_type")))
    )


def _null_seed(spark: SparkSession) -> DataFrame:
    """The payment seed with one code repeated and one null code."""
    seed = star.payment_seed(spark).drop("is_electronic")
    more = spark.createDataFrame(
        [(6, "Again"), (None, "No code"), (None, "Code unknown")],
        "payment_key int, payment_type string",
    )
    return seed.unionByName(more)


def entry(spark: SparkSession) -> DataFrame:
    """Raw tables to written star, then the ten busiest pickup zones."""
    mart = star_of(spark, "/root/testdata/sf0.001")
    return reports.top_zones(mart.fact, mart.dim_zone)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on_trips: dict[str, Callable[[DataFrame], DataFrame]] = {
        "valid_trips": lambda t: _split(quality.valid_trips(t)),
        "rejected_trips": lambda t: _split(quality.rejected_trips(t), "rejection_reason"),
        "undecided_trips": lambda t: _split(quality.undecided_trips(t)),
        "rejection_reasons": lambda t: quality.rejected_trips(t, composed=True)
        .groupBy("rejection_reason")
        .agg(F.count(F.lit(1)).alias("trips")),
        "split_counts": quality.split_counts,
        "quality_report": lambda t: quality.quality_report(quality.split_counts(t)),
        "dim_date": lambda t: star.build_dim_date(quality.valid_trips(t)),
        "dim_payment": lambda t: star.build_dim_payment(quality.valid_trips(t)),
        "dim_date_attrs": lambda t: star.calendar_attributes(
            star.build_dim_date(quality.valid_trips(t))
        ),
        "fact_trips": lambda t: _plain(
            star.build_fact_trips(quality.valid_trips(t)).drop("trip_id", "congestion_surcharge")
        ),
    }
    on_star: dict[str, Callable] = {
        "q1_last_month": lambda s: reports.last_month(s.fact, s.dim_date, AS_OF),
        "q1_from_dates": lambda s: reports.last_month_of_dates(s.fact, s.dim_date, AS_OF),
        "quarter_from_dates": lambda s: reports.quarter_summary(s.fact, s.dim_date, YEAR, 2),
        "vw_monthly_summary_kept": lambda s: maintained.monthly_summary(
            s.fact.sparkSession, _kept_totals(s)
        ),
        "vw_zone_revenue_kept": lambda s: maintained.zone_revenue(
            s.fact.sparkSession, _kept_totals(s)
        ),
        "trip_id_duplicates": _planted_duplicates,
        "q2_top_zones": lambda s: reports.top_zones(s.fact, s.dim_zone),
        "q3_borough_revenue": lambda s: reports.borough_revenue(s.fact, s.dim_zone),
        "q4_zone_duration": lambda s: reports.zone_durations(s.fact, s.dim_zone),
        "q5_payment_mix": lambda s: reports.payment_mix(s.fact, s.dim_payment),
        "vw_monthly_summary": lambda s: reports.monthly_summary(s.fact, s.dim_date).orderBy(
            "year", "month"
        ),
        "vw_zone_revenue": lambda s: reports.zone_revenue(s.fact, s.dim_zone).orderBy(
            F.desc("total_revenue"), "zone_name"
        ),
        "avg_fare_month": lambda s: reports.average_fare_of_month(s.fact, s.dim_date, YEAR, MONTH),
        "partition_pruned_scan": lambda s: reports.month_scan(s.fact, PRUNED_YEAR, PRUNED_MONTH),
        "top_zones_by_revenue": lambda s: reports.top_zones_by_revenue(s.fact, s.dim_zone),
        "borough_total": lambda s: reports.borough_totals(s.fact, s.dim_zone),
        "top_pickup_zones": lambda s: reports.top_pickup_zones(s.fact, s.dim_zone),
        "top_dropoff_zones": lambda s: reports.top_dropoff_zones(s.fact, s.dim_zone),
        "top_zone_keys": lambda s: reports.top_zone_keys(s.fact),
        "top_routes": lambda s: reports.top_routes(s.fact, s.dim_zone),
        "zone_pair_count": lambda s: reports.zone_pair_count(
            s.fact, s.dim_zone, FROM_ZONE, TO_ZONE
        ),
        "pickups_to_zone": lambda s: reports.pickups_to_zone(s.fact, s.dim_zone, TO_ZONE),
        "fact_count": lambda s: reports.trip_count(s.fact),
        "global_averages": lambda s: reports.global_averages(s.fact),
        "payment_breakdown": lambda s: reports.payment_breakdown(s.fact, s.dim_payment),
        "payment_electronic": lambda s: reports.electronic_payments(
            s.fact, star.payment_seed(s.fact.sparkSession)
        ),
        "preview": lambda s: reports.preview(s.dim_date, "date_key"),
        "preview_dim_payment": lambda s: reports.preview(s.dim_payment, "payment_key"),
        "preview_dim_zone": lambda s: reports.preview(s.dim_zone, "zone_key"),
        "preview_fact": lambda s: _plain(
            reports.preview(s.fact.drop("trip_id", "congestion_surcharge"), *PREVIEW_ORDER)
        ),
        "type_fit_audit": lambda s: audit.by_table(
            {
                name: audit.type_fit_audit(rows.drop("trip_id"), audit.DECLARED[name])
                for name, rows in warehouse_tables(s).items()
            }
        ),
        "fact_after_month_reload": _after_reload,
        "scd0_payment_null": lambda s: dimensions.keep_first(
            s.dim_payment, _null_seed(s.fact.sparkSession), "payment_key"
        ),
        "scd0_payment_twice": lambda s: dimensions.keep_first(
            dimensions.keep_first(s.dim_payment, _null_seed(s.fact.sparkSession), "payment_key"),
            _null_seed(s.fact.sparkSession),
            "payment_key",
        ),
        "fact_roundtrip": lambda s: _roundtrip(s.fact),
        "partition_layout": lambda s: audit.partition_layout(s.fact),
        "trip_id_unique": lambda s: s.fact.agg(
            F.count(F.lit(1)).alias("trips"), F.count_distinct("trip_id").alias("ids")
        ),
        "fk_orphans": lambda s: _foreign_keys(s.fact, s),
        "fk_orphans_by_bits": lambda s: _foreign_keys(s.fact, s, audit.foreign_key_audit_by_bits),
        "scd0_payment": lambda s: dimensions.keep_first(
            s.dim_payment,
            star.payment_seed(s.fact.sparkSession).drop("is_electronic"),
            "payment_key",
        ),
    }
    named: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "raw_trips": lambda spark, d: _plain(order_line_trips(spark, d)),
        "trip_duration": lambda spark, d: trip_duration(order_line_trips(spark, d)).select(
            "l_orderkey", "l_linenumber", "trip_duration"
        ),
        "time_columns": lambda spark, d: pickup_calendar(order_line_trips(spark, d)).select(
            "l_orderkey", "l_linenumber", "pickup_date", "pickup_year", "pickup_month"
        ),
        "payment_text": lambda spark, d: payment_description(order_line_trips(spark, d)).select(
            "l_orderkey", "l_linenumber", "payment_type", "payment_type_desc"
        ),
        "dim_zone": nation_zones,
        "unfit_values": lambda spark, d: _unfit(_too_large(spark, d)),
        "null_audit": lambda spark, d: audit.by_table(
            {
                name: audit.null_audit(rows, audit.NOT_NULL[name])
                for name, rows in warehouse_tables(star_of(spark, d)).items()
            }
            | {"raw_trips": audit.null_audit(_trips(spark, d), RAW_AUDITED)}
        ),
        "fk_null_keys": lambda spark, d: _foreign_keys(
            _null_keys(_trips(spark, d)), star_of(spark, d)
        ),
        "pk_duplicates": _primary_keys,
        "split_counts_while_writing": lambda spark, d: metrics.split_counts(
            spark, *_written_while_counting(spark, d)
        ),
        "fact_nulls_while_writing": lambda spark, d: metrics.null_audit(
            spark, _written_while_counting(spark, d)[0]
        ),
        "fact_after_new_files": _after_new_files,
        "fk_orphans_unchecked": lambda spark, d: _foreign_keys(
            star.fact_measures(_trips(spark, d)), star_of(spark, d)
        ),
        "fk_unchecked_by_bits": lambda spark, d: _foreign_keys(
            star.fact_measures(_trips(spark, d)), star_of(spark, d), audit.foreign_key_audit_by_bits
        ),
        "fk_orphan_dates": lambda spark, d: audit.orphan_keys(
            _trips(spark, d), "pickup_date", star_of(spark, d).dim_date, "date_key"
        ),
        "scd1_zone": lambda spark, d: dimensions.overwrite_changed(
            nation_zones(spark, d), _renamed_zones(spark, d), "zone_key"
        ),
    }
    named |= {
        name: (lambda spark, d, f=f: f(_trips(spark, d))) for name, f in on_trips.items()
    }
    named |= {
        name: (lambda spark, d, f=f: f(star_of(spark, d))) for name, f in on_star.items()
    }
    return named | (llm.queries() if llm else {})


# -- oracle --------------------------------------------------------------------

OK = "trip_duration > 0 and fare_amount >= 0 and trip_distance >= 0"
REASON = quality.CONSTANT_REASON

# The warehouse's tables in terms of the views below.
WAREHOUSE_ROWS = {
    "dim_date": """(select cast(year * 10000 + month * 100 + day as int) as date_key,
        date_key as "date", day, month, quarter, year, monthname(date_key) as month_name,
        dayofweek(date_key) + 1 as day_of_week, dayofweek(date_key) in (0, 6) as is_weekend
        from dim_date)""",
    "dim_geography": """(select zone_key, "Zone" as zone_name, "Borough" as borough
        from dim_zone)""",
    "dim_payment": """(select p.payment_key, p.payment_type,
        coalesce(s.is_electronic, false) as is_electronic
        from dim_payment p left join payment_seed s on p.payment_key = s.payment_key)""",
    "fact_trips": """(select * replace (cast(year(pickup_date_key) * 10000
        + month(pickup_date_key) * 100 + day(pickup_date_key) as int) as pickup_date_key),
        cast(null as decimal(12,2)) as congestion_surcharge from fact_trips)""",
}
NULL_SEEDED = """
    select payment_key, payment_type from dim_payment
    union all select payment_key, payment_type from (values (1, 'Credit card'), (2, 'Cash'),
        (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'), (6, 'Again'), (null, 'Code unknown'))
        as v(payment_key, payment_type)
    where not exists (select 1 from dim_payment p
                      where p.payment_key is not distinct from v.payment_key)"""

VIEWS = {
    "raw_trips": """
        select l_orderkey, l_linenumber,
               o_orderdate as tpep_pickup_datetime, l_shipdate as tpep_dropoff_datetime,
               cast(substr(o_orderpriority, 1, 1) as int) as payment_type,
               c_nationkey as "PULocationID", s_nationkey as "DOLocationID",
               l_linenumber as passenger_count,
               cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end
                    as decimal(12,2)) as fare_amount,
               cast(nullif(l_quantity, 1.0) as decimal(12,2)) as trip_distance,
               cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))
                    as tip_amount,
               cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
                    as toll_amount,
               cast(l_extendedprice as decimal(12,2))
                    * (1 - cast(l_discount as decimal(4,2)) + cast(l_tax as decimal(4,2)))
                    as total_amount
        from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join supplier on l_suppkey = s_suppkey""",
    "trips": """
        select *,
               date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) as trip_duration,
               cast(tpep_pickup_datetime as date) as pickup_date,
               cast(year(tpep_pickup_datetime) as int) as pickup_year,
               cast(month(tpep_pickup_datetime) as int) as pickup_month,
               case payment_type when 1 then 'Credit card' when 2 then 'Cash'
                    when 3 then 'No charge' when 4 then 'Dispute' else 'Unknown' end
                    as payment_type_desc
        from raw_trips""",
    "valid_trips": f"select * from trips where {OK}",
    "rejected_trips": f"select *, '{REASON}' as rejection_reason from trips where not ({OK})",
    "fact_trips": """
        select pickup_date as pickup_date_key, "PULocationID" as pickup_zone_key,
               "DOLocationID" as dropoff_zone_key, payment_type as payment_key,
               fare_amount, trip_distance, trip_duration, passenger_count,
               total_amount, tip_amount, toll_amount, pickup_year, pickup_month
        from valid_trips""",
    "dim_date": """
        select distinct pickup_date as date_key, pickup_year as "year", pickup_month as "month",
               cast(day(pickup_date) as int) as "day",
               cast(quarter(pickup_date) as int) as "quarter"
        from valid_trips""",
    "dim_payment": """
        select distinct payment_type as payment_key, payment_type_desc as payment_type
        from valid_trips""",
    "dim_zone": """
        select n_nationkey as zone_key, r_name as "Borough", n_name as "Zone"
        from nation join region on n_regionkey = r_regionkey""",
    "payment_seed": """
        select * from (values (1, 'Credit card', true), (2, 'Cash', false),
            (3, 'No charge', false), (4, 'Dispute', false), (5, 'Unknown', false),
            (6, 'Voided trip', false)) as v(payment_key, payment_type, is_electronic)""",
    "zoned": """
        select f.*, z."Zone" as zone_name, z."Borough" as borough
        from fact_trips f join dim_zone z on f.pickup_zone_key = z.zone_key""",
}
PREFIX = "with " + ",\n".join(f"{name} as ({body})" for name, body in VIEWS.items()) + "\n"


def _r2(value: str) -> str:
    return f"cast(round(cast({value} as decimal(28,8)), 2) as double)"


def _av(column: str) -> str:
    return _r2(f"cast(sum({column}) as double) / count({column})")


def _minutes_av(column: str) -> str:
    return _r2(f"cast(sum({column}) as double) / count({column}) / 60.0")


def _money(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


def _nulls(table_name: str, rows: str, column: str) -> str:
    return (f"select '{table_name}' as table_name, '{column}' as column_name, "
            f"count(case when \"{column}\" is null then 1 end) as nulls from {rows}")


def _fits(table: str, rows: str, column: str, kind: str) -> str:
    """One row of the type-fit audit; numbers are measured by size, text by length."""
    base, _, size = kind.rstrip(")").partition("(")
    value, length, largest = f'"{column}"', "null", f'cast(max(abs("{column}")) as double)'
    if base == "DECIMAL":
        digits, places = map(int, size.split(","))
        good = (f"abs({value}) < 1e{digits - places} and cast({value} as decimal(38,10)) = "
                f"round(cast({value} as decimal(38,10)), {places})")
    elif base == "VARCHAR":
        good, length, largest = f"length({value}) <= {size}", f"max(length({value}))", "null"
    elif base in audit.RANGES:
        least, most = audit.RANGES[base]
        good = f"{value} between {least} and {most}"
    else:
        good, largest = "true", "null"
    return f"""select '{table}' as table_name, '{column}' as column_name,
        '{kind}' as warehouse_type, cast({length} as bigint) as max_length,
        cast({largest} as double) as max_abs, coalesce(bool_and({good}), true) as fits from {rows}"""


def _orphans(rows: str, column: str, dim: str, key: str, name: str) -> str:
    return f"""
        select '{name}' as foreign_key,
               count(distinct case when k.{key} is null then r.{column} end) as orphan_keys,
               count(case when k.{key} is null and r.{column} is not null then 1 end)
                   as orphan_rows,
               count(case when r.{column} is null then 1 end) as null_rows
        from {rows} r left join {dim} k on r.{column} = k.{key}"""


def _all_orphans(rows: str, date: str, pickup: str, dropoff: str, payment: str) -> str:
    return " union all ".join(
        [
            _orphans(rows, date, "dim_date", "date_key", "pickup_date_key"),
            _orphans(rows, pickup, "dim_zone", "zone_key", "pickup_zone_key"),
            _orphans(rows, dropoff, "dim_zone", "zone_key", "dropoff_zone_key"),
            _orphans(rows, payment, "dim_payment", "payment_key", "payment_key"),
        ]
    )


def _duplicates(rows: str, key: str, name: str) -> str:
    return (f"select '{name}' as table_name, count(*) as duplicate_keys from "
            f"(select {key} from {rows} group by {key} having count(*) > 1) d")


def oracle_sql() -> dict[str, str]:
    split = "l_orderkey, l_linenumber, trip_duration, " + _money("fare_amount", "trip_distance")
    month_before = f"date '{AS_OF}' - interval '1' month"
    texts = {
        "raw_trips": f"""select l_orderkey, l_linenumber, tpep_pickup_datetime,
            tpep_dropoff_datetime, payment_type, "PULocationID", "DOLocationID", passenger_count,
            {_money("fare_amount", "trip_distance", "tip_amount", "toll_amount", "total_amount")}
            from raw_trips""",
        "trip_duration": "select l_orderkey, l_linenumber, trip_duration from trips",
        "time_columns": """select l_orderkey, l_linenumber, pickup_date, pickup_year, pickup_month
            from trips""",
        "payment_text": """select l_orderkey, l_linenumber, payment_type, payment_type_desc
            from trips""",
        "valid_trips": f"select {split} from valid_trips",
        "rejected_trips": f"select {split}, rejection_reason from rejected_trips",
        "undecided_trips": f"select {split} from trips where ({OK}) is null",
        "rejection_reasons": """select concat_ws(',',
                case when trip_duration <= 0 then 'time_inversion' end,
                case when fare_amount < 0 then 'negative_fare' end,
                case when trip_distance < 0 then 'negative_distance' end) as rejection_reason,
            count(*) as trips from rejected_trips group by 1""",
        "split_counts": f"""select count(*) as total, count(case when {OK} then 1 end) as valid,
            count(case when not ({OK}) then 1 end) as rejected,
            count(case when ({OK}) is null then 1 end) as undecided,
            count(case when {OK} and greatest(abs(fare_amount), trip_distance) >= 1e12 then 1 end)
                as unfit from trips""",
        "quality_report": f"""select total, valid, rejected, undecided, unfit,
            {_r2("case when total > 0 then valid * 100.0 / total else 0 end")} as pct_valid,
            {_r2("case when total > 0 then rejected * 100.0 / total else 0 end")} as pct_rejected
            from (select count(*) as total, count(case when {OK} then 1 end) as valid,
                count(case when not ({OK}) then 1 end) as rejected,
                count(case when ({OK}) is null then 1 end) as undecided,
                count(case when {OK} and greatest(abs(fare_amount), trip_distance) >= 1e12
                      then 1 end) as unfit from trips) c""",
        "unfit_values": f"""
            select 'Value does not fit: ' || concat_ws(',',
                case when "PULocationID" + l_orderkey * 100000 > 2147483647 then 'PULocationID' end,
                case when l_linenumber % 2 = 1 then 'DOLocationID' end,
                case when cast(fare_amount as double) * 2e7 >= 999999999999.9999995 then 'fare_amount'
                end) as rejection_reason, count(*) as trips,
                sum(cast(fare_amount as double) * 2e7) as fares
            from trips where coalesce({OK}, true) and ("PULocationID" + l_orderkey * 100000 > 2147483647
                or l_linenumber % 2 = 1 or cast(fare_amount as double) * 2e7 >= 999999999999.9999995)
            group by 1""",
        "null_audit": " union all ".join(
            [_nulls(t, WAREHOUSE_ROWS[t], c) for t, columns in audit.NOT_NULL.items()
             for c in columns if c != "trip_id"]
            + ["select 'fact_trips', 'trip_id', cast(0 as bigint)"]
            + [_nulls("raw_trips", "trips", c) for c in RAW_AUDITED]
        ),
        "type_fit_audit": " union all ".join(
            _fits(t, WAREHOUSE_ROWS[t], c, kind)
            for t, columns in audit.DECLARED.items() for c, kind in columns.items()
            if c not in ("trip_id", "service_zone")
        ),
        "dim_date": "select * from dim_date",
        "dim_payment": "select * from dim_payment",
        "dim_zone": "select * from dim_zone",
        "dim_date_attrs": """select cast(year * 10000 + month * 100 + day as int) as date_key,
            date_key as "date", day, month, quarter, year, monthname(date_key) as month_name,
            cast(dayofweek(date_key) + 1 as int) as day_of_week,
            (dayofweek(date_key) + 1) in (1, 7) as is_weekend from dim_date""",
        "fact_trips": f"""select pickup_date_key, pickup_zone_key, dropoff_zone_key, payment_key,
            {_money("fare_amount", "trip_distance", "total_amount", "tip_amount", "toll_amount")},
            trip_duration, passenger_count, pickup_year, pickup_month from fact_trips""",
        "fact_roundtrip": """select pickup_year, pickup_month, count(*) as trips,
            cast(sum(fare_amount) as double) as revenue from fact_trips group by 1, 2""",
        # A month here is far smaller than a file may be, so the write makes one of each.
        "partition_layout": """select pickup_year, pickup_month, count(*) as trips,
            cast(1 as bigint) as files from fact_trips group by 1, 2""",
        "fact_after_new_files": """select pickup_year, pickup_month, count(*) as trips,
            count(*) as ids, cast(sum(fare_amount) as double) as revenue
            from fact_trips group by 1, 2""",
        "trip_id_duplicates": f"""select count(*) as duplicate_keys,
            cast(2 * count(*) as bigint) as trips from fact_trips
            where pickup_year = {YEAR} and pickup_month = {MONTH}""",
        "fact_nulls_while_writing": " union all ".join(
            f"select '{c}' as column_name, count(case when {c} is null then 1 end) as nulls from fact_trips"
            for c in audit.NOT_NULL["fact_trips"] if c != "trip_id"
        ),
        "trip_id_unique": "select count(*) as trips, count(*) as ids from fact_trips",
        "q1_last_month": f"""select d.year, d.month, count(*) as total_trips,
            {_av("f.fare_amount")} as avg_fare_amount, {_av("f.total_amount")} as avg_total_amount,
            {_av("f.tip_amount")} as avg_tip_amount
            from fact_trips f join dim_date d on f.pickup_date_key = d.date_key
            where d.year = cast(extract(year from {month_before}) as int)
              and d.month = cast(extract(month from {month_before}) as int)
            group by d.year, d.month""",
        "q2_top_zones": f"""select zone_name, borough, count(*) as total_trips,
            {_r2("sum(fare_amount)")} as total_revenue, {_av("fare_amount")} as avg_fare,
            {_av("trip_distance")} as avg_distance_miles
            from zoned group by zone_name, borough
            order by total_trips desc, zone_name, borough limit 10""",
        "q3_borough_revenue": f"""select borough, count(*) as total_trips,
            {_r2("sum(fare_amount)")} as total_fare_revenue,
            {_r2("sum(total_amount)")} as total_gross_revenue,
            {_av("fare_amount")} as avg_fare, {_av("trip_distance")} as avg_distance_miles,
            {_r2("cast(sum(fare_amount) as double) * 100.0"
                 " / cast(sum(sum(fare_amount)) over () as double)")} as revenue_pct
            from zoned group by borough""",
        "q4_zone_duration": f"""select zone_name, borough, count(*) as total_trips,
            {_minutes_av("trip_duration")} as avg_duration_minutes,
            {_r2("percentile_cont(0.5) within group (order by cast(trip_duration as double)/60.0)")}
                as median_duration_minutes,
            {_av("trip_distance")} as avg_distance_miles, {_av("fare_amount")} as avg_fare
            from zoned where trip_duration > 0 group by zone_name, borough
            order by total_trips desc, zone_name, borough limit 20""",
        "q5_payment_mix": f"""select p.payment_type, count(*) as total_trips,
            {_r2("sum(f.fare_amount)")} as total_revenue, {_av("f.fare_amount")} as avg_fare,
            {_av("f.tip_amount")} as avg_tip,
            {_r2("count(*) * 100.0 / cast(sum(count(*)) over () as double)")} as pct_of_trips
            from fact_trips f join dim_payment p on f.payment_key = p.payment_key
            group by p.payment_type""",
        "vw_monthly_summary": f"""select d.year, d.month, count(*) as total_trips,
            {_av("f.fare_amount")} as avg_fare, {_r2("sum(f.fare_amount)")} as total_revenue,
            {_av("f.trip_distance")} as avg_distance,
            {_minutes_av("f.trip_duration")} as avg_duration_minutes
            from fact_trips f join dim_date d on f.pickup_date_key = d.date_key
            group by d.year, d.month""",
        "vw_zone_revenue": f"""select zone_name, borough, count(*) as total_trips,
            {_r2("sum(fare_amount)")} as total_revenue, {_av("fare_amount")} as avg_fare
            from zoned group by zone_name, borough""",
        "avg_fare_month": f"""select {_av("f.fare_amount")} as avg_fare
            from fact_trips f join dim_date d on f.pickup_date_key = d.date_key
            where d.year = {YEAR} and d.month = {MONTH}""",
        "partition_pruned_scan": f"""select count(*) as trips, {_av("fare_amount")} as avg_fare
            from fact_trips
            where pickup_year = {PRUNED_YEAR} and pickup_month = {PRUNED_MONTH}""",
        "top_zones_by_revenue": f"""select zone_name, {_r2("sum(fare_amount)")} as revenue
            from zoned group by zone_name order by sum(fare_amount) desc, zone_name limit 5""",
        "borough_total": f"""select borough, {_r2("sum(fare_amount)")} as total_revenue
            from zoned group by borough""",
        "top_pickup_zones": """select zone_name, count(*) as trips from zoned
            group by zone_name order by trips desc, zone_name limit 5""",
        "top_dropoff_zones": """select z."Zone" as zone_name, count(*) as trips
            from fact_trips f join dim_zone z on f.dropoff_zone_key = z.zone_key
            group by 1 order by trips desc, zone_name limit 5""",
        "top_zone_keys": """select pickup_zone_key, count(*) as trips from fact_trips
            group by 1 order by trips desc, pickup_zone_key limit 5""",
        "top_routes": """select p."Zone" as pickup_zone, q."Zone" as dropoff_zone,
            count(*) as trips
            from fact_trips f join dim_zone p on f.pickup_zone_key = p.zone_key
            join dim_zone q on f.dropoff_zone_key = q.zone_key
            group by 1, 2 order by trips desc, pickup_zone, dropoff_zone limit 10""",
        "zone_pair_count": f"""select count(*) as trips
            from fact_trips f join dim_zone p on f.pickup_zone_key = p.zone_key
            join dim_zone q on f.dropoff_zone_key = q.zone_key
            where p.zone_key = {FROM_ZONE} and q.zone_key = {TO_ZONE}""",
        "pickups_to_zone": f"""select zone_name, count(*) as trips from zoned
            where dropoff_zone_key = {TO_ZONE} group by zone_name""",
        "fact_count": "select count(*) as trips from fact_trips",
        "global_averages": f"""select {_av("fare_amount")} as avg_fare,
            {_av("trip_distance")} as avg_distance from fact_trips""",
        "payment_breakdown": """select p.payment_type, count(*) as trips
            from fact_trips f join dim_payment p on f.payment_key = p.payment_key
            group by p.payment_type""",
        "payment_electronic": """select s.payment_type, s.is_electronic, count(*) as trips
            from fact_trips f join payment_seed s on f.payment_key = s.payment_key
            group by 1, 2""",
        "preview": "select * from dim_date order by date_key limit 5",
        "pk_duplicates": " union all ".join(
            [
                _duplicates("dim_date", "date_key", "dim_date"),
                _duplicates("dim_payment", "payment_key", "dim_payment"),
                _duplicates("dim_zone", "zone_key", "dim_zone"),
                "select 'fact_trips', 0",
                _duplicates("lineitem", "l_orderkey, l_linenumber", "order_lines"),
            ]
        ),
        "fk_orphans": _all_orphans(
            "fact_trips", "pickup_date_key", "pickup_zone_key", "dropoff_zone_key", "payment_key"
        ),
        "fk_orphans_unchecked": _all_orphans(
            "trips", "pickup_date", '"PULocationID"', '"DOLocationID"', "payment_type"
        ),
        "fk_orphan_dates": """select pickup_date as "key", count(*) as "rows" from trips t
            where not exists (select 1 from dim_date d where d.date_key = t.pickup_date)
            group by pickup_date""",
        "preview_dim_payment": """select * from dim_payment
            order by payment_key nulls first limit 5""",
        "preview_dim_zone": "select * from dim_zone order by zone_key limit 5",
        "preview_fact": f"""select pickup_date_key, pickup_zone_key, dropoff_zone_key, payment_key,
            {_money("fare_amount", "trip_distance", "total_amount", "tip_amount", "toll_amount")},
            trip_duration, passenger_count, pickup_year, pickup_month from fact_trips
            order by {", ".join(f"fact_trips.{c} nulls first" for c in PREVIEW_ORDER)} limit 5""",
        "fact_after_month_reload": """select pickup_year, count(*) as trips, count(*) as ids
            from fact_trips group by 1""",
        "fk_null_keys": _all_orphans(
            "(select *, case when l_linenumber % 3 <> 0 then payment_type end as code from trips)",
            "pickup_date", '"PULocationID"', '"DOLocationID"', "code",
        ),
        "scd0_payment_null": NULL_SEEDED,
        "scd0_payment_twice": NULL_SEEDED,
        "scd0_payment": """select payment_key, payment_type from payment_seed s
            where not exists (select 1 from dim_payment p where p.payment_key = s.payment_key)
            union all select payment_key, payment_type from dim_payment""",
        "scd1_zone": """
            select * from dim_zone o where not exists
                (select 1 from dim_zone n where n.zone_key + 20 = o.zone_key)
            union all select zone_key + 20, "Borough", "Zone" from dim_zone""",
    }
    # The same questions, answered another way.
    texts |= {
        "q1_from_dates": texts["q1_last_month"],
        "fk_orphans_by_bits": texts["fk_orphans"],
        "fk_unchecked_by_bits": texts["fk_orphans_unchecked"],
        "split_counts_while_writing": texts["split_counts"],
        "vw_monthly_summary_kept": texts["vw_monthly_summary"],
        "vw_zone_revenue_kept": texts["vw_zone_revenue"],
        "quarter_from_dates": f"""select * from ({texts["vw_monthly_summary"]}) s
            where year = {YEAR} and month between 4 and 6""",
    }
    own = {name: PREFIX + text for name, text in texts.items()}
    return own | (llm.oracle_sql() if llm else {})
