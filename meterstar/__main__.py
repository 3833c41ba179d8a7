"""Command line: `etl` runs the job on files or order-line tables, `report` shows the
warehouse report."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.errors import AnalysisException

from meterstar.plans.etl import run_files, run_tables
from meterstar.plans.increment import load_new_files
from meterstar.plans.reports import preview, warehouse_report
from meterstar.session import build_session
from meterstar.sinks.connector import copy_star, snowflake_options
from meterstar.sources.warehouse import read_star


def _etl(args: argparse.Namespace) -> int:
    spark = build_session("meterstar-etl")
    try:
        options = dict(
            composed=args.composed_reasons,
            already_by_month=args.already_by_month,
            sort_stage=args.sort_stage,
        )
        if args.new_files:
            result = load_new_files(
                spark, args.raw, args.zones, args.warehouse, args.quarantine, args.composed_reasons
            )
            if result is None:
                print("no new files")
                return 0
        elif args.tables:
            options["stage"] = args.stage or True
            result = run_tables(spark, args.tables, args.warehouse, args.quarantine, **options)
        else:
            options["stage"] = args.stage or False
            result = run_files(
                spark, args.raw, args.zones, args.warehouse, args.quarantine, **options
            )
        copied = copy_star(result.star, snowflake_options(os.environ))
        for name, rows in result.star.tables().items():
            print(name)
            preview(rows, rows.columns[0]).show(truncate=False)
        result.quality.show()
        result.nulls.show(truncate=False)
        print("copied:", ", ".join(copied) or "nothing, no credentials")
    except (AnalysisException, ValueError) as error:
        print(f"cannot run on {args.raw or args.tables}: {error}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


def _report(args: argparse.Namespace) -> int:
    spark = build_session("meterstar-report")
    try:
        star = read_star(spark, args.warehouse)
        for name, part in warehouse_report(star.fact, star.dim_payment, star.dim_zone).items():
            print(name)
            part.show(truncate=False)
    except AnalysisException as error:
        print(f"cannot read {args.warehouse}: {error}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="meterstar")
    commands = parser.add_subparsers(required=True)

    etl = commands.add_parser("etl", help="raw trip files to warehouse and quarantine")
    source = etl.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", nargs="+", help="globs or folders of files")
    source.add_argument("--tables", help="folder of order-line tables, instead of files")
    etl.add_argument("--zones", default="zones.csv", help="zone lookup CSV; may be missing")
    etl.add_argument("--stage", help="folder in which raw trips are kept for both outputs")
    etl.add_argument("--sort-stage", action="store_true",
                     help="order the kept raw trips so that reads skip rejected ones")
    etl.add_argument("--warehouse", required=True)
    etl.add_argument("--quarantine", required=True)
    etl.add_argument("--new-files", action="store_true",
                     help="load only the --raw files that the warehouse has not seen")
    etl.add_argument("--composed-reasons", action="store_true")
    etl.add_argument("--already-by-month", action="store_true")
    etl.set_defaults(run=_etl)

    report = commands.add_parser("report", help="show the warehouse report")
    report.add_argument("--warehouse", required=True)
    report.set_defaults(run=_report)

    args = parser.parse_args(argv)
    if getattr(args, "new_files", False) and not args.raw:
        parser.error("--new-files goes with --raw")
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
