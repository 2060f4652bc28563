"""Times the headline jobs: `BENCH_SF_DIR=... BENCH_CPUS=8 python bench.py` prints one JSON line.

Every job runs `RUNS` times after a warm-up, writing to nowhere, and its median counts; figures and checks read the star
schema that the `star_build` entry stores, as dashboards read a saved warehouse. `csv_load` loads the nine raw tables
from CSV files, which are written first and not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercaloom.plans import catalog
from mercaloom.session import build_session
from mercaloom.sources import tables as T
from mercaloom.sources.schemas import STAGING

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINES = (
    "dim_customer",
    "dim_product",
    "fact_sales",
    "profile_orders",
    "profile_order_items",
    "profile_customers",
    "profile_payments",
    "profile_reviews",
    "orphan_order_items",
    "unsold_products",
    "price_describe",
    "orders_without_items",
    "kpi_revenue_lines",
    "kpi_top_category",
    "kpi_top_state",
    "kpi_delivery",
    "kpi_late_rate",
    "kpi_values",
    "revenue_by_category_state",
    "fk_violations",
)


def shuffle_bytes(spark) -> int:
    """Bytes written to shuffles by all stages so far."""
    gateway = spark.sparkContext._gateway
    no_quantiles = gateway.new_array(gateway.jvm.double, 0)
    any_status = gateway.jvm.java.util.ArrayList()
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, no_quantiles, any_status)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main() -> None:
    spark = build_session(
        "mercaloom-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mercaloom-warehouse-"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="mercaloom-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_linestatus").count().collect()

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    workspaces = catalog.Workspaces()
    jobs = catalog.queries(workspaces)
    seconds: dict[str, float] = {}
    shuffled: dict[str, int] = {}

    def measure(name: str, job, runs: int = RUNS) -> None:
        taken = []
        for _ in range(runs):
            before, started = shuffle_bytes(spark), time.perf_counter()
            job()
            taken.append(time.perf_counter() - started)
            shuffled[name] = shuffle_bytes(spark) - before
        seconds[name] = round(statistics.median(taken), 3)

    files = tempfile.mkdtemp(prefix="mercaloom-csv-")
    for name, table in workspaces.get(spark, FOLDER).staging.items():
        table.write.options(header=True, escape='"').csv(f"{files}/{name}")
    T.create_databases(spark)

    def load() -> None:
        for name in STAGING:
            T.load_table(spark, name, f"{files}/{name}")

    measure("csv_load", load)
    run(jobs["fact_sales"](spark, FOLDER))  # warm-up
    for name in HEADLINES:
        if name == "kpi_revenue_lines":  # the first that needs the stored star schema, built once
            measure("star_build", lambda: workspaces.get(spark, FOLDER).star, runs=1)
        measure(name, lambda: run(jobs[name](spark, FOLDER)))

    print(
        json.dumps(
            {
                "metric": "star schema build, profiles, checks and figures",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "shuffle_bytes": shuffled,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
