"""Loads of new files, maintained totals, metrics of writes, swaps that die, ids by intervals."""

import os
import random
import subprocess
import sys
import textwrap
from datetime import date
from decimal import Decimal
from glob import glob

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from meterstar.__main__ import main
from meterstar.operators import audit, quality
from meterstar.operators.derive import derive_trips
from meterstar.operators.star import fact_measures
from meterstar.plans import etl, increment, maintained, reports
from meterstar.schemas import MONEY
from meterstar.sinks import loads, metrics, swap
from meterstar.sinks.connector import copy_star
from meterstar.sinks.warehouse import recover_warehouse, replace_table, write_fact
from meterstar.sources.tables import order_line_trips
from meterstar.sources.trips import read_trips
from meterstar.sources.warehouse import Star, read_star

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted(map(repr, df.collect()))


def snapshot(spark, root):
    return {n: rows(t.drop("trip_id")) for n, t in read_star(spark, root).tables().items()}


def year_98(spark):
    """A year of the raw trips, which is twelve months to write."""
    return order_line_trips(spark, SMALL).filter("year(tpep_pickup_datetime) = 1998")


@pytest.fixture
def place(spark, tmp_path):
    """Paths of a job, and a function that adds raw files of some orders."""
    raw = year_98(spark)

    def add(name, condition, **changes):
        part = raw.filter(condition).withColumns(changes)
        part.coalesce(1).write.parquet(f"{tmp_path}/raw/{name}")

    args = [f"{tmp_path}/raw/*"], f"{tmp_path}/none.csv", f"{tmp_path}/w", f"{tmp_path}/q"
    return args, add


@pytest.fixture
def full(spark, tmp_path):
    """A full run over the same raw files, elsewhere."""
    def run(args):
        return etl.run_files(spark, args[0], args[1], f"{tmp_path}/w-full", f"{tmp_path}/q-full")

    return run


def test_new_files_alone_are_read_and_the_star_equals_a_full_run(spark, place, full, tmp_path):
    args, add = place
    add("a", "l_orderkey % 3 = 0")
    first = increment.load_new_files(spark, *args)
    assert increment.load_new_files(spark, *args) is None
    add("b", "l_orderkey % 3 = 1")
    add("c", "l_orderkey % 3 = 2 and l_orderkey < 3000")
    load = loads.next_load(spark, args[2], *args[0])
    assert load.number == 1 and sorted(p.split("/raw/")[1][0] for p in load.paths) == ["b", "c"]
    old = {r.trip_id: repr(r) for r in first.star.fact.collect()}
    second = increment.load_new_files(spark, *args)
    all_files = full(args)
    assert snapshot(spark, args[2]) == snapshot(spark, f"{tmp_path}/w-full")
    fact = second.star.fact
    assert fact.count() == fact.select("trip_id").distinct().count()
    now = {r.trip_id: repr(r) for r in fact.collect()}
    assert old.items() <= now.items() and min(now.keys() - old.keys()) > max(old)
    counts = [r.quality.first() for r in (first, second, all_files)]
    assert counts[0].total + counts[1].total == counts[2].total
    quarantine = spark.read.parquet(args[3])
    assert {r.load for r in quarantine.select("load").distinct().collect()} == {0, 1}
    assert rows(quarantine.drop("load")) == rows(spark.read.parquet(f"{tmp_path}/q-full"))
    assert rows(maintained.monthly_summary(spark, args[2])) == rows(
        reports.monthly_summary(all_files.star.fact, all_files.star.dim_date))
    # A full run forgets the log: the next load starts anew.
    etl.run_files(spark, *args)
    assert loads.next_load(spark, args[2], *args[0]).number == 0


STEPS = ["begin", "write_fact", "replace_table", "load_quarantine", "finish"]


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_dies_is_repeated_without_doubles(spark, place, full, tmp_path, monkeypatch, step):
    args, add = place
    add("a", "l_orderkey % 4 = 0")
    increment.load_new_files(spark, *args)
    add("b", "l_orderkey % 4 = 1")
    own = getattr(increment, step)

    def dies(*a, **b):
        own(*a, **b)  # what the step did stays
        raise KeyboardInterrupt

    monkeypatch.setattr(increment, step, dies)
    with pytest.raises(KeyboardInterrupt):
        increment.load_new_files(spark, *args)
    monkeypatch.undo()
    add("c", "l_orderkey % 4 = 2")
    increment.load_new_files(spark, *args)
    full(args)
    assert snapshot(spark, args[2]) == snapshot(spark, f"{tmp_path}/w-full")
    fact = read_star(spark, args[2]).fact
    assert fact.count() == fact.select("trip_id").distinct().count()
    assert audit.duplicate_ids(fact).count() == 0
    assert rows(spark.read.parquet(args[3]).drop("load")) == rows(spark.read.parquet(f"{tmp_path}/q-full"))


def test_changed_and_lost_files_ask_for_a_full_run(spark, place, tmp_path):
    args, add = place
    add("a", "l_orderkey % 5 = 0")
    increment.load_new_files(spark, *args)
    file = glob(f"{tmp_path}/raw/a/*.parquet")[0]
    os.utime(file, (1, 1))
    with pytest.raises(ValueError, match="1 files changed"):
        increment.load_new_files(spark, *args)


def test_command_line_loads_new_files(monkeypatch, spark, place, capsys):
    args, add = place
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    add("a", "l_orderkey % 7 = 0")
    command = ["etl", "--new-files", "--raw", *args[0], "--zones", args[1], "--warehouse", args[2], "--quarantine", args[3]]
    assert main(command) == 0 and "dim_date" in capsys.readouterr().out
    assert main(command) == 0 and "no new files" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["etl", "--new-files", "--tables", SMALL, "--warehouse", args[2], "--quarantine", args[3]])


def test_files_of_one_glob_may_differ_in_types(spark, place, tmp_path):
    args, add = place
    count = F.col("passenger_count")
    add("1997", "l_orderkey % 4 = 0", passenger_count=count.cast("int"))
    add("1998", "l_orderkey % 4 = 1", passenger_count=count.cast("double"))
    add("1999", "l_orderkey % 4 = 2", passenger_count=count.cast("double"), more=F.lit("x"))
    add("2000", "l_orderkey % 4 = 3", passenger_count=count.cast("int"))
    trips = read_trips(spark, *args[0])
    assert dict(trips.dtypes)["passenger_count"] == "double" and "more" in trips.columns
    plain = year_98(spark).withColumn("passenger_count", count.cast("double"))
    assert rows(trips.select(plain.columns)) == rows(plain)
    assert trips.filter("more = 'x'").count() == plain.filter("l_orderkey % 4 = 2").count()
    # One scan for each set of types, not for each file.
    plan = trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    result = etl.run_files(spark, *args)
    assert result.quality.first().total == plain.count()


def test_totals_are_renewed_from_the_named_months_alone(spark, mart, tmp_path, explained):
    root = str(tmp_path)
    from meterstar.sinks.warehouse import write_star

    star = write_star(mart.fact.drop("trip_id"), root, mart.dim_zone)
    maintained.refresh(spark, root)
    assert rows(maintained.monthly_summary(spark, root)) == rows(reports.monthly_summary(star.fact, star.dim_date))
    one = star.fact.filter("pickup_year = 1998 and pickup_month = 3").drop("trip_id")
    write_fact(one.withColumn("fare_amount", (F.col("fare_amount") + 1).cast(MONEY)), f"{root}/fact_trips", months_only=True)
    before = {f: os.path.getmtime(f) for f in glob(f"{root}/fact_totals/*/*/*.parquet")}
    maintained.refresh(spark, root, [(1998, 3)])
    after = {f: os.path.getmtime(f) for f in glob(f"{root}/fact_totals/*/*/*.parquet")}
    changed = {f.split("/part-")[0] for f in before.keys() ^ after.keys()}
    assert changed == {f"{root}/fact_totals/pickup_year=1998/pickup_month=3"}
    now = read_star(spark, root)
    assert rows(maintained.monthly_summary(spark, root)) == rows(reports.monthly_summary(now.fact, now.dim_date))
    assert rows(maintained.zone_revenue(spark, root)) == rows(reports.zone_revenue(now.fact, now.dim_zone))
    picked = now.fact.filter(reports.in_months([(1998, 3)]))
    assert len({r[0] for r in picked.select(F.input_file_name()).distinct().collect()}) == 1
    # A month that lost its last trip.
    swap.remove_folder(spark, f"{root}/fact_trips/pickup_year=1998/pickup_month=3")
    maintained.refresh(spark, root, [(1998, 3)])
    assert not os.path.exists(f"{root}/fact_totals/pickup_year=1998/pickup_month=3")


def files_scanned(df, table, metric="numFiles"):
    """A metric of the finished query's scans of a table: by default, how many files it read."""
    df.collect()
    seen, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec" and table in node.toString():
            seen += node.longMetric(metric).value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return seen


def test_dates_alone_prune_the_fact_at_run_time(mart, explained):
    asked = reports.quarter_summary(mart.fact, mart.dim_date, 1998, 2)
    assert "dynamicpruning" in explained(asked)
    assert {(r.year, r.month) for r in asked.collect()} == {(1998, 4), (1998, 5), (1998, 6)}
    dates = mart.dim_date.filter("date_key between '1998-03-02' and '1998-03-05'")
    days = reports.of_dates(mart.fact, dates, ["fare_amount"], ["year", "month"])
    assert "dynamicpruning" in explained(days)
    assert files_scanned(days, "pickup_date_key") == 1
    assert files_scanned(reports.monthly_summary(mart.fact, mart.dim_date), "pickup_date_key") > 70


def test_metrics_of_a_write_equal_scans_and_need_none(spark, tmp_path):
    raw = order_line_trips(spark, DATA)
    trips = derive_trips(raw)
    result = etl.run(raw, f"{tmp_path}/w", f"{tmp_path}/q")
    counts = quality.split_counts(trips)
    assert rows(result.quality) == rows(quality.quality_report(counts))
    assert rows(result.quality) == rows(quality.quality_report(etl.written_counts(result.star.fact, result.set_aside)))
    checked = [c for c in audit.NOT_NULL["fact_trips"] if c != "trip_id"]
    assert rows(result.nulls) == rows(audit.null_audit(result.star.fact, checked))
    seen = metrics.WriteMetrics(["payment_key"])
    none = fact_measures(trips.withColumn("payment_type", F.lit(None).cast("int")).limit(50))
    write_fact(none, f"{tmp_path}/none", metrics=seen)
    assert (seen.get("rows"), seen.get("nulls of payment_key")) == (50, 50)
    empty = metrics.WriteMetrics(["payment_key"])
    write_fact(fact_measures(trips).limit(0), f"{tmp_path}/empty", metrics=empty)
    assert empty.get("rows") == 0


def test_metrics_count_a_retried_task_once(tmp_path):
    """In a session of its own, where tasks may fail; each writing task fails once."""
    script = f"""
        import sys
        sys.path[:0] = [{ROOT!r}]
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from meterstar.operators import quality
        from meterstar.operators.derive import derive_trips
        from meterstar.operators.star import fact_measures
        from meterstar.sinks.metrics import WriteMetrics
        from meterstar.sinks.warehouse import write_fact
        from meterstar.sources.tables import order_line_trips
        spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "3").config("spark.sql.warehouse.dir", "{tmp_path}/wh").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")

        class Failing(WriteMetrics):
            def observe(self, rows):
                seen = super().observe(rows)
                def run(batches):
                    yield from batches
                    if TaskContext.get().attemptNumber() == 0:
                        raise ValueError("the first try fails at its end")
                return seen.mapInArrow(run, rows.schema)

        valid = fact_measures(quality.valid_trips(derive_trips(order_line_trips(spark, {SMALL!r}))))
        metrics = Failing(["payment_key"])
        write_fact(valid, "{tmp_path}/fact", metrics=metrics)
        print("SEEN", metrics.get("rows"), spark.read.parquet("{tmp_path}/fact").count())
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert "SEEN 2086 2086" in out.stdout, out.stderr[-2000:]


# -- swaps ----------------------------------------------------------------------


def test_a_swap_that_dies_at_any_step_loses_no_table(spark, tmp_path, monkeypatch):
    calls = [getattr(swap, n) for n in ("rename_folder", "remove_folder")]

    def dying(after, late):
        left = [after]

        def wrap(own):
            def call(*a):
                left[0] -= 1
                if left[0] == 0 and not late:
                    raise KeyboardInterrupt
                own(*a)
                if left[0] == 0:
                    raise KeyboardInterrupt
            return call

        for own in calls:
            monkeypatch.setattr(swap, own.__name__, wrap(own))

    seen = set()
    for late in (False, True):
        for after in range(1, 9):
            root = f"{tmp_path}/{late}{after}"
            replace_table(spark.range(3), root, "dim_zone")
            dying(after, late)
            try:
                replace_table(spark.range(5), root, "dim_zone")
                done = True
            except KeyboardInterrupt:
                done = False
            monkeypatch.undo()
            recover_warehouse(spark, root)
            seen.add(spark.read.parquet(f"{root}/dim_zone").count())
            assert os.listdir(root) == ["dim_zone"]
            assert replace_table(spark.range(7), root, "dim_zone").count() == 7
            assert os.listdir(root) == ["dim_zone"]
        assert done  # beyond the last step
    assert seen == {3, 5}


def test_half_done_states_of_a_swap(spark, tmp_path):
    def state(name, *folders):
        for folder, rows, complete in folders:
            spark.range(rows).write.parquet(f"{tmp_path}/{name}/{folder}")
            if not complete:
                os.remove(f"{tmp_path}/{name}/{folder}/_SUCCESS")
        swap.recover_table(spark, f"{tmp_path}/{name}/t")
        assert os.listdir(f"{tmp_path}/{name}") == ["t"]
        return spark.read.parquet(f"{tmp_path}/{name}/t").count()

    assert state("a", ("t", 3, True), ("t_next", 5, False)) == 3
    assert state("b", ("t_old", 3, True), ("t_next", 5, True)) == 5
    assert state("c", ("t_old", 3, True), ("t_next", 5, False)) == 3
    assert state("d", ("t_old", 3, True)) == 3
    assert state("e", ("t", 5, True), ("t_old", 3, True)) == 5
    assert state("f", ("t_next", 5, True)) == 5


def test_refused_renames_fail(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(3).write.parquet(f"{tmp_path}/b")
    with pytest.raises(swap.SwapError, match="is there"):
        swap.rename_folder(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    with pytest.raises(swap.SwapError, match="cannot rename"):
        swap.rename_folder(spark, f"{tmp_path}/none", f"{tmp_path}/c")
    with pytest.raises(swap.SwapError, match="not complete"):
        swap.swap_in(spark, f"{tmp_path}/a")


@pytest.mark.parametrize("after", range(1, 9))
def test_months_that_were_half_swapped_are_finished(spark, tmp_path, monkeypatch, after):
    months = spark.range(6).selectExpr("id", "1998 as pickup_year", "cast(id % 3 as int) as pickup_month")
    table = f"{tmp_path}/fact_trips"
    months.write.partitionBy("pickup_year", "pickup_month").parquet(table)
    later = months.filter("pickup_month > 0").withColumn("id", F.col("id") + 10)
    later.write.partitionBy("pickup_year", "pickup_month").parquet(table + swap.PARTS)
    own, left = swap.rename_folder, [after]

    def dies(*a):
        left[0] -= 1
        if left[0] == 0:
            raise KeyboardInterrupt
        own(*a)

    monkeypatch.setattr(swap, "rename_folder", dies)
    try:
        swap.swap_parts(spark, table)
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    swap.recover_parts(spark, table)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [0, 3, 11, 12, 14, 15]
    assert os.listdir(tmp_path) == ["fact_trips"]


def test_a_copy_that_fails_leaves_the_target_as_it_was(spark, mart, tmp_path):
    target = {"root": str(tmp_path)}
    copy_star(mart, target, fmt="parquet", target="path")
    before = {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in mart.tables()}
    bad = mart.dim_zone.select(F.raise_error(F.lit("no third table")).alias("zone_key"))
    other = Star(mart.fact.limit(1), mart.dim_date.limit(1), mart.dim_payment.limit(1), bad)
    with pytest.raises(Exception, match="no third table"):
        copy_star(other, target, fmt="parquet", target="path")
    assert {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in mart.tables()} == before
    good = Star(mart.fact.limit(1), mart.dim_date.limit(1), mart.dim_payment.limit(1))
    for _ in range(2):
        assert copy_star(good, target, fmt="parquet", target="path") == ["dim_date", "dim_payment", "fact_trips"]
    assert spark.read.parquet(f"{tmp_path}/fact_trips").count() == 1
    assert sorted(os.listdir(tmp_path)) == sorted(mart.tables())


# -- ids by intervals --------------------------------------------------------------


def test_ids_as_written_are_cleared_without_shuffling_them(mart, explained):
    runs = audit.id_runs(mart.fact)
    assert all(r.steady and r.high - r.low + 1 == r.rows for r in runs.collect())
    assert audit.doubtful_blocks(runs).count() == 0
    found = audit.duplicate_ids(mart.fact)
    assert found.count() == 0 and "trip_id" not in explained(audit.doubtful_blocks(runs)).split("Exchange")[-1].split("\n\n")[0]
    assert "Scan parquet" not in explained(found)


def test_duplicates_of_any_kind_are_found(spark, mart, tmp_path):
    fact = mart.fact.select("trip_id")
    some = [r.trip_id for r in fact.orderBy("trip_id").limit(6).collect()]
    first = fact.coalesce(1).sortWithinPartitions("trip_id")

    def check(name, *parts):
        for i, part in enumerate(parts):
            part.write.mode("append").parquet(f"{tmp_path}/{name}")
        written = spark.read.parquet(f"{tmp_path}/{name}")
        assert rows(audit.duplicate_ids(written)) == rows(audit.duplicate_keys(written, ["trip_id"]))
        return audit.duplicate_ids(written).count()

    one = spark.createDataFrame([(some[0],), (some[0],), (some[2],)], "trip_id bigint").coalesce(1)
    assert check("inside", one) == 1  # as many as their span, but not all different
    assert check("across", first, fact.filter(F.col("trip_id") == some[3])) == 1
    assert check("nulls", spark.createDataFrame([(None,), (None,), (1,)], "trip_id bigint")) == 1
    assert check("shuffled", first.orderBy(F.xxhash64("trip_id"))) == 0
    assert check("many", first, first) == fact.count()


# -- values that no warehouse type holds ---------------------------------------------


def test_type_audit_survives_and_reports_bad_values(spark):
    nan, inf = float("nan"), float("inf")
    kinds = {"DECIMAL(10,2)": [1e25, nan, inf, -inf, 1e300, 1e8, 0.125], "SMALLINT": [1e25, nan, inf, 40000.0, 1.5],
             "BIGINT": [1e19, nan, 0.5]}
    for kind, values in kinds.items():
        for value in values:
            df = spark.createDataFrame([(value,), (3.0,), (None,)], "fare_amount double")
            row = audit.type_fit_audit(df, {"fare_amount": kind}).first()
            assert row.fits is False, (kind, value)
        good = spark.createDataFrame([(12.0,), (None,)], "fare_amount double")
        assert audit.type_fit_audit(good, {"fare_amount": kind}).first().fits is True
    wide = spark.createDataFrame([(Decimal(10**30),)], "total_amount decimal(38,0)")
    assert audit.type_fit_audit(wide).first().fits is False
    whole = spark.createDataFrame([(2**40,), (5,)], "passenger_count bigint")
    assert audit.type_fit_audit(whole, {"passenger_count": "INTEGER"}).first().fits is False
    assert audit.type_fit_audit(whole, {"passenger_count": "BIGINT"}).first().fits is True


def test_counts_work_out_each_outcome_once(spark, explained):
    plan = explained(quality.split_counts(derive_trips(order_line_trips(spark, SMALL))))
    assert plan.count("'rejected'") <= 2 and "outcome" in plan
    none = quality.split_counts(derive_trips(order_line_trips(spark, SMALL)).limit(0)).first()
    assert set(none.asDict().values()) == {0}


# -- references by bitmaps -----------------------------------------------------------


def test_references_by_bits_equal_those_by_keys(spark):
    rng = random.Random(7)

    def check(keys, known, kind="bigint"):
        dim = spark.createDataFrame([(k, "x") for k in known], f"k {kind}, name string")
        fact = spark.createDataFrame([(a, b) for a, b in zip(keys, reversed(keys))], f"a {kind}, b {kind}")
        references = {"a": (dim, "k"), "b": (dim.filter("k is null or k <> k"), "k")}
        by_bits = audit.foreign_key_audit_by_bits(fact, references)
        assert rows(by_bits) == rows(audit.foreign_key_audit(fact, references))
        assert by_bits.schema == audit.foreign_key_audit(fact, references).schema

    far = [-(2**63), 2**63 - 1, 0, -1, 63, 64, 65, None]
    check(far, [-1, 0, 63, 64, 127, 128, 40_000, None, 0])
    check([rng.randrange(-70_000, 70_000) for _ in range(3000)], [rng.randrange(-70_000, 70_000) for _ in range(900)])
    check(far, [0, 2**40])  # too far apart for bits
    check(far, [])
    check([], [1])
    check([None, None], [1])
    days = [date(1969, 12, 31), date(1970, 1, 1), date(2024, 2, 29), None, date(1, 1, 1)]
    check(days, days[1:3], "date")
    check(["a", "b", None], ["a"], "string")


def test_references_by_bits_expand_nothing(mart, spark, monkeypatch):
    plans = []
    own = type(mart.fact).agg
    monkeypatch.setattr(type(mart.fact), "agg", lambda self, *a: (plans.append(own(self, *a)), plans[-1])[1])
    found = audit.foreign_key_audit_by_bits(mart.fact, {
        "pickup_zone_key": (mart.dim_zone, "zone_key"), "pickup_date_key": (mart.dim_date, "date_key")})
    assert {(r.orphan_keys, r.orphan_rows) for r in found.collect()} == {(0, 0)}
    assert not any("Expand" in p._jdf.queryExecution().toString() for p in plans)


# -- row groups ----------------------------------------------------------------------


def test_sorted_files_let_the_rules_skip_row_groups(spark, tmp_path, explained):
    raw = order_line_trips(spark, SMALL).coalesce(1)
    files = {"plain": raw, "sorted": quality.sorted_for_rules(raw)}
    read = {}
    for name, trips in files.items():
        for kind in ("double", "decimal(12,2)"):
            typed = trips.withColumns({c: F.col(c).cast(kind) for c in ("fare_amount", "trip_distance")})
            path = f"{tmp_path}/{name}-{kind[:3]}"
            typed.write.option("parquet.block.size", 16_384).option("parquet.page.size", 2048).parquet(path)
            valid = quality.valid_trips(derive_trips(read_trips(spark, path)))
            pushed = explained(valid)
            assert "GreaterThanOrEqual(fare_amount,0.0" in pushed and "GreaterThanOrEqual(trip_distance,0.0" in pushed
            read[name, kind] = files_scanned(valid.select("l_orderkey"), "fare_amount", "numOutputRows")
            assert valid.count() == 2086
    negative = raw.filter("fare_amount < 0").count()
    for kind in ("double", "decimal(12,2)"):
        assert read["plain", kind] == 6000 and read["sorted", kind] <= 6000 - 0.8 * negative


def test_a_sorted_stage_gives_the_same_outputs(spark, tmp_path):
    raw = year_98(spark)
    plain = etl.run(raw, f"{tmp_path}/w1", f"{tmp_path}/q1")
    other = etl.run(raw, f"{tmp_path}/w2", f"{tmp_path}/q2", stage=f"{tmp_path}/s", sort_stage=True)
    assert snapshot(spark, f"{tmp_path}/w1") == snapshot(spark, f"{tmp_path}/w2")
    assert rows(plain.set_aside) == rows(other.set_aside) and rows(plain.quality) == rows(other.quality)
