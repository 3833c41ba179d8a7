"""Time the headline jobs and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the number of
warm runs; each figure is the median of the warm runs after one discarded run.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from meterstar.operators import audit, quality
from meterstar.operators.derive import derive_trips
from meterstar.operators.star import (
    build_dim_date,
    build_dim_payment,
    build_fact_trips,
    fact_measures,
)
from meterstar.plans import etl, maintained, reports
from meterstar.plans.increment import load_new_files
from meterstar.session import build_session
from meterstar.sinks.warehouse import write_fact, write_star, write_table
from meterstar.sources.tables import nation_zones, order_line_trips

DIRECTORY = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def files_read(rows) -> int:
    return rows.select(F.input_file_name()).distinct().count()


def recomputing_etl(raw, zones, out) -> None:
    """The same outputs with every count, preview and table computed from the raw trips."""
    trips = derive_trips(raw)
    valid, rejected = quality.valid_and_rejected(trips)
    raw.count(), valid.count(), rejected.count()
    dates, payments, fact = build_dim_date(valid), build_dim_payment(valid), build_fact_trips(valid)
    for table in (dates, payments, zones, fact):
        table.limit(5).collect()
    write_table(dates, f"{out}/dim_date")
    write_table(payments, f"{out}/dim_payment")
    write_table(zones, f"{out}/dim_zone")
    fact.write.mode("overwrite").partitionBy("pickup_year", "pickup_month").parquet(f"{out}/fact")
    write_table(rejected, f"{out}/rejected")


def main() -> None:
    spark = (
        build_session(
            "meterstar-bench",
            spark__master=f"local[{CPUS}]",
            spark__sql__shuffle__partitions=CPUS,
            spark__ui__enabled="false",
            spark__ui__showConsoleProgress="false",
            spark__driver__memory="8g",
            # A few megabytes in all: smaller partitions, so that writes use every core.
            spark__sql__adaptive__advisoryPartitionSizeInBytes="16m",
        )
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="meterstar-bench-")
    raw, zones = order_line_trips(spark, DIRECTORY), nation_zones(spark, DIRECTORY)
    valid = quality.valid_trips(derive_trips(raw))
    measures = fact_measures(valid)

    times = {
        "etl_full": timed(lambda: etl.run(raw, f"{out}/w", f"{out}/q", zones).quality.collect()),
        "etl_staged": timed(
            lambda: etl.run(raw, f"{out}/w", f"{out}/q", zones, stage=True).quality.collect()
        ),
        "etl_recomputing": timed(lambda: recomputing_etl(raw, zones, f"{out}/again")),
        "etl_star_only": timed(lambda: write_star(measures, f"{out}/star", zones)),
    }
    # As with tables that are too large to broadcast.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, stage in (("etl_full_no_broadcast", False), ("etl_staged_no_broadcast", True)):
        times[name] = timed(
            lambda: etl.run(raw, f"{out}/w", f"{out}/q", zones, stage=stage).quality.collect()
        )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    star = write_star(measures, f"{out}/star", zones)
    fact = star.fact

    def run(query):
        # A new DataFrame per run: collecting one again would reuse its finished stages.
        return timed(lambda: query().collect())

    one_month = star.dim_date.filter("year = 1998 and month = 3")
    times |= {
        "q1_last_month": run(lambda: reports.last_month(fact, star.dim_date, "1998-04-15")),
        "q1_without_partition_filter": run(lambda: reports.monthly_summary(fact, one_month)),
        "q2_top_zones": run(lambda: reports.top_zones(fact, star.dim_zone)),
        "q3_borough_revenue": run(lambda: reports.borough_revenue(fact, star.dim_zone)),
        "q4_zone_duration": run(lambda: reports.zone_durations(fact, star.dim_zone)),
        "q4_approximate_median": run(
            lambda: reports.zone_durations(fact, star.dim_zone, approximate=True)
        ),
        "q5_payment_mix": run(lambda: reports.payment_mix(fact, star.dim_payment)),
        "vw_monthly_summary": run(lambda: reports.monthly_summary(fact, star.dim_date)),
        "vw_zone_revenue": run(lambda: reports.zone_revenue(fact, star.dim_zone)),
        "top_routes": run(lambda: reports.top_routes(fact, star.dim_zone)),
        "pickups_to_zone": run(lambda: reports.pickups_to_zone(fact, star.dim_zone, 7)),
        "global_averages": run(lambda: reports.global_averages(fact)),
        "partition_pruned_scan": run(lambda: reports.month_scan(fact, 1998, 3)),
        "partition_layout": run(lambda: audit.partition_layout(fact)),
        "split_counts_from_raw": run(lambda: quality.split_counts(derive_trips(raw))),
        "dim_date_from_raw": run(lambda: build_dim_date(valid)),
    }

    references = {
        "pickup_date_key": (star.dim_date, "date_key"),
        "pickup_zone_key": (star.dim_zone, "zone_key"),
        "dropoff_zone_key": (star.dim_zone, "zone_key"),
        "payment_key": (star.dim_payment, "payment_key"),
    }
    kept = f"{out}/star"
    maintained.refresh(spark, kept)
    # A warehouse of files, and one more file a run: a month's trips.
    month = raw.filter("tpep_pickup_datetime between '1998-03-01' and '1998-03-31'").coalesce(1)
    raw.write.parquet(f"{out}/files/all")
    place = [f"{out}/files/*"], f"{out}/no-zones.csv", f"{out}/loaded", f"{out}/loaded-aside"
    load_new_files(spark, *place)

    def one_more_file():
        month.write.parquet(f"{out}/files/{time.monotonic_ns()}")
        load_new_files(spark, *place)

    times |= {
        "dates_last_month": run(lambda: reports.last_month_of_dates(fact, star.dim_date, "1998-04-15")),
        "dates_quarter": run(lambda: reports.quarter_summary(fact, star.dim_date, 1998, 2)),
        "kept_monthly_summary": run(lambda: maintained.monthly_summary(spark, kept)),
        "kept_zone_revenue": run(lambda: maintained.zone_revenue(spark, kept)),
        "renew_totals_of_one_month": timed(lambda: maintained.refresh(spark, kept, [(1998, 3)])),
        "load_one_new_file": timed(one_more_file),
        "fk_audit": run(lambda: audit.foreign_key_audit(fact, references)),
        "fk_audit_by_bits": run(lambda: audit.foreign_key_audit_by_bits(fact, references)),
        "pk_audit_of_ids": run(lambda: audit.duplicate_keys(fact, ["trip_id"])),
        "pk_audit_by_intervals": run(lambda: audit.duplicate_ids(fact)),
    }

    write_fact(measures.repartition(int(CPUS)), f"{out}/plain", already_by_month=True)
    counts = {
        "fact_rebalanced": len(glob.glob(f"{out}/star/fact_trips/*/*/*.parquet")),
        "fact_not_rebalanced": len(glob.glob(f"{out}/plain/*/*/*.parquet")),
        "q1_read": files_read(fact.filter("pickup_year = 1998 and pickup_month = 3")),
        "q1_read_without_partition_filter": files_read(fact),
    }
    headline = ["etl_full", *(n for n in times if n.startswith("q") and n.count("_without") == 0
                              and n != "q4_approximate_median")]
    print(
        json.dumps(
            {
                "metric": "full ETL plus the five warehouse queries",
                "value": round(sum(times[n] for n in headline), 3),
                "unit": "sec",
                "queries": times,
                "files": counts,
                "sf": os.path.basename(DIRECTORY.rstrip("/")).removeprefix("sf"),
                "master": f"local[{CPUS}]",
                "shuffle_partitions": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
