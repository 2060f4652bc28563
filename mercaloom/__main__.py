"""Command line: `python -m mercaloom load|profile|check|build|refresh|kpis|run`, also for spark-submit."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession

from .operators.integrity import check_integrity
from .operators.profile import profile, render_profile
from .operators.storage import drop_intermediates
from .plans import pipeline
from .plans.dimensions import CALENDAR_END, CALENDAR_START
from .session import build_session
from .sources import tables as T
from .sources.schemas import STAGING, WAREHOUSE


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="mercaloom")
    parser.add_argument("step", choices=("load", "profile", "check", "build", "refresh", "kpis", "run"))
    parser.add_argument("--data", help="folder of the CSV files")
    parser.add_argument("--tables", nargs="*", default=list(STAGING), help="tables to profile")
    parser.add_argument("--on-reject", choices=("fail", "quarantine"), default="fail")
    day = datetime.date.fromisoformat
    parser.add_argument("--start", type=day, default=CALENDAR_START, help="first calendar day")
    parser.add_argument("--end", type=day, default=CALENDAR_END, help="last calendar day")
    parser.add_argument(
        "--on-violation", choices=("stop", "report"), default="stop", help="when a declared constraint is broken"
    )
    parser.add_argument("--buckets", type=int, default=0, help="files by order_id for each table that has one")
    parser.add_argument("--by-month", action="store_true", help="cut the fact by month of purchase")
    parser.add_argument("--months", nargs="*", type=int, default=[], help="months (yyyyMM) to refresh")
    parser.add_argument("--ordered", action="store_true", help="number the fact by order and line")
    args = parser.parse_args(arguments)
    if args.step in ("load", "run") and not args.data:
        parser.error("--data is needed to load")

    spark = build_session()
    try:
        _run(spark, args)
    finally:
        drop_intermediates(spark)


def _list(database: str, tables: dict[str, DataFrame]) -> None:
    """Where the full results are, and how many rows each has."""
    for name, table in tables.items():
        print(f"{database}.{name}: {table.count()} rows")


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "load":
        _list(T.STAGING_DATABASE, T.load_all(spark, args.data, args.on_reject, buckets=args.buckets))
        return
    if args.step == "run":
        days = args.start, args.end
        _list(T.WAREHOUSE_DATABASE, pipeline.run(spark, args.data, args.on_reject, *days, args.ordered, args.on_violation, args.by_month, args.buckets))
        return
    staging = T.saved_tables(spark, T.STAGING_DATABASE, STAGING)
    if args.step == "profile":
        rendered = {name: render_profile(profile(staging[name], name)) for name in args.tables}
        for name, saved in pipeline.save_reports(rendered, "profile_", T.STAGING_DATABASE).items():
            print(f"{T.STAGING_DATABASE}.{name}")
            saved.show(saved.count(), truncate=False)  # one row per column
    elif args.step == "refresh":
        _list(T.WAREHOUSE_DATABASE, {"fact_sales": pipeline.refresh_months(spark, staging, args.months)})
    elif args.step == "build":
        star = pipeline.build_warehouse(spark, staging, args.start, args.end, args.ordered, by_month=args.by_month)
        _list(T.WAREHOUSE_DATABASE, {**star, **pipeline.check_star(staging, star, args.on_violation, pipeline.written_counts(spark))})
    else:
        star = T.saved_tables(spark, T.WAREHOUSE_DATABASE, WAREHOUSE)
        if args.step == "check":
            _list(T.WAREHOUSE_DATABASE, pipeline.save_reports(check_integrity(staging)))
            _list(T.WAREHOUSE_DATABASE, pipeline.check_star(staging, star, args.on_violation, pipeline.written_counts(spark)))
        else:
            for name, saved in pipeline.save_kpis(star, staging["orders"]).items():
                print(f"{T.WAREHOUSE_DATABASE}.{name}")
                saved.show(saved.count(), truncate=False)  # a figure per group at most


if __name__ == "__main__":
    main()
