"""Command line: load seeds, build the marts, run the checks.

    python -m shoplens seed --root R [--append] [--most-bad SHARE] raw_products=products.csv ...
    python -m shoplens run --root R [--as-of DAY] [--select MART ...] [--publish]
    python -m shoplens test --root R
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from shoplens.plans.build import MARTS, StoredRaw, build_all, check_all, read_all, table_path
from shoplens.plans.catalog import publish
from shoplens.session import sized_session
from shoplens.sources import RAW_SCHEMAS, load_raw, read_csv
from shoplens.sources.quarantine import load_csv


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shoplens")
    commands = parser.add_subparsers(dest="command", required=True)
    seed = commands.add_parser("seed", help="load CSV files as raw tables")
    seed.add_argument("files", nargs="+", metavar="TABLE=CSV")
    seed.add_argument("--append", action="store_true", help="keep the rows that are there")
    seed.add_argument(
        "--most-bad", type=float, help="keep bad lines aside, up to this share; else they raise"
    )
    run = commands.add_parser("run", help="build marts")
    run.add_argument("--select", nargs="+", choices=MARTS, default=MARTS)
    run.add_argument("--full-refresh", action="store_true")
    run.add_argument("--lookback-days", type=int, default=0)
    run.add_argument("--publish", action="store_true", help="name the tables in the catalog")
    run.add_argument("--check-keys", action="store_true", help="refuse repeated dimension keys")
    test = commands.add_parser("test", help="print failed checks; status 1 if there are any")
    for command in (seed, run, test):
        command.add_argument("--root", required=True, help="folder of the warehouse")
    for command in (run, test):
        command.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    builder = SparkSession.builder.appName("shoplens")
    if args.command == "seed":
        inputs = [item.partition("=")[2] for item in args.files]
    else:
        inputs = [table_path(args.root, "raw", table) for table in RAW_SCHEMAS]
    spark = sized_session(builder, inputs)
    if args.command == "seed":
        for item in args.files:
            table, _, path = item.partition("=")
            if table not in RAW_SCHEMAS:
                raise SystemExit(f"{table} is none of {', '.join(RAW_SCHEMAS)}")
            to = table_path(args.root, "raw", table)
            if args.most_bad is None:
                load_raw(read_csv(spark, path, table), table, to, append=args.append)
                continue
            rejected = table_path(args.root, "raw", f"{table}_rejected")
            good, bad = load_csv(
                spark, path, table, to, rejected, most_bad=args.most_bad, append=args.append
            )
            print(f"{table}: {good} lines loaded, {bad} rejected")
        return 0
    raw = StoredRaw(spark, args.root)
    if args.command == "run":
        build_all(
            spark, raw, args.root, args.as_of, full_refresh=args.full_refresh,
            lookback=dt.timedelta(args.lookback_days) or None, select=args.select,
            check_keys=args.check_keys,
        )
        if args.publish:
            publish(spark, args.root)
        return 0
    # one row per check
    counts = check_all(read_all(spark, raw, args.root, args.as_of)).collect()
    failed = [row for row in counts if row["failures"]]
    for row in failed:
        print(f"{row['model']}.{row['column_name']} {row['test']}: {row['failures']} failures")
    print(f"{len(counts) - len(failed)} of {len(counts)} checks passed")
    return int(bool(failed))


if __name__ == "__main__":
    raise SystemExit(main())
