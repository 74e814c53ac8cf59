"""Run the job or generate a raw table, with ``python -m veritide`` or ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from veritide.plans.job import STAGES, run_job
from veritide.sources.faults import RATES, ROWS, SEED, generate_customers
from veritide.sources.tables import write_csv


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="veritide", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run every stage on a raw table")
    run.add_argument("source", help="file or folder")
    run.add_argument("--format", choices=["csv", "parquet", "orc"], default="csv", help="what the source is")
    run.add_argument("folder", help="where results go; all executors must reach it")
    run.add_argument("--as-of", type=dt.date.fromisoformat, help="day that ages are taken at")
    run.add_argument("--row-id", help="a column that numbers the rows")
    run.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    run.add_argument("--stage", action="append", choices=list(STAGES), help="run these stages only")
    run.add_argument("--csv", action="store_true", help="also write the tables as CSV")
    generate = commands.add_parser("generate", help="write generated customers as CSV")
    generate.add_argument("folder")
    generate.add_argument("--rows", type=int, default=ROWS)
    generate.add_argument("--seed", type=int, default=SEED)
    for name, rate in RATES.items():
        generate.add_argument(f"--{name.replace('_', '-')}", type=float, default=rate)
    generate.add_argument("--exact-duplicates", action="store_true", help="that rate as an exact number of rows")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("veritide").getOrCreate()
    if args.command == "generate":
        rates = {name: getattr(args, name) for name in RATES}
        made = generate_customers(spark, args.rows, args.seed, **rates, exact_duplicates=args.exact_duplicates)
        write_csv(made, args.folder)
        return
    source = args.source if args.format == "csv" else spark.read.format(args.format).load(args.source)
    report = run_job(
        spark, source, args.folder, args.as_of, args.row_id, args.csv, multi_line=args.multi_line, stages=args.stage
    )
    for stage in report.stages:
        print(f"{stage.status} {stage.name} {stage.seconds}s {stage.details}")


if __name__ == "__main__":
    main()
