"""End to end: CSV files, raw tables, star schema, figures."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.integrity import (
    Counts,
    Tables,
    counted_reports,
    foreign_key_report,
    length_report,
    not_null_report,
    primary_key_report,
)
from ..operators.keys import row_identity, sorted_ranges
from ..operators.skew import MIN_HOT_ROWS
from ..sources import tables as T
from ..sources.cut_tables import refresh_cut, save_cut
from ..sources.schemas import FOREIGN_KEYS, STAGING, WAREHOUSE
from . import kpis
from .dimensions import (
    CALENDAR_END,
    CALENDAR_START,
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_dim_seller,
)
from .fact import MONTH, build_fact_sales, lines_of_months, with_month

DECLARED = {**STAGING, **WAREHOUSE}


def build_star(
    staging: Tables,
    dim_date: DataFrame,
    ordered: bool = False,
    min_hot_rows: int = MIN_HOT_ROWS,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
    number_fact: Callable[[DataFrame, str], DataFrame] = row_identity,
) -> dict[str, DataFrame]:
    """Dimensions first, then the fact that refers to them; `keep` may save each dimension, `number_fact` writes and numbers
    the fact."""
    words = staging["category_translation"]
    star = {
        "dim_date": keep("dim_date", dim_date),
        "dim_customer": keep("dim_customer", build_dim_customer(staging["customers"])),
        "dim_seller": keep("dim_seller", build_dim_seller(staging["sellers"])),
        "dim_product": keep(
            "dim_product", build_dim_product(staging["products"], words, min_hot_rows)
        ),
    }
    return {**star, "fact_sales": build_fact_sales(staging, star, ordered, min_hot_rows, number_fact)}


def build_warehouse(
    spark: SparkSession,
    staging: Tables,
    start: datetime.date = CALENDAR_START,
    end: datetime.date = CALENDAR_END,
    ordered: bool = False,
    min_hot_rows: int = MIN_HOT_ROWS,
    by_month: bool = False,
) -> dict[str, DataFrame]:
    """Build and save the star schema. May be run again.

    `by_month` cuts the fact by month of purchase, which costs a range shuffle; single months can then be refreshed.
    """
    T.create_databases(spark)

    def save(name: str, df: DataFrame) -> DataFrame:
        return T.save_table(df, T.WAREHOUSE_DATABASE, name, WAREHOUSE[name])

    def save_fact(lines: DataFrame, key: str) -> DataFrame:
        if by_month:
            cut = sorted_ranges(with_month(lines), MONTH, "order_id", "order_item_id")
            return save_cut(cut, T.WAREHOUSE_DATABASE, "fact_sales", key, MONTH, WAREHOUSE["fact_sales"])
        return T.save_numbered(lines, T.WAREHOUSE_DATABASE, "fact_sales", key, WAREHOUSE["fact_sales"])

    return build_star(staging, build_dim_date(spark, start, end), ordered, min_hot_rows, save, save_fact)


def refresh_months(spark: SparkSession, staging: Tables, months: Collection[int], min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Rebuild the sales of some months of purchase (yyyyMM) from the raw tables; all other rows of the saved fact stay.

    An order whose date moved needs both its months. Customers, sellers and products are looked up in the saved
    dimensions.
    """
    dims = T.saved_tables(spark, T.WAREHOUSE_DATABASE, [n for n in WAREHOUSE if n.startswith("dim_")])
    lines = sorted_ranges(lines_of_months(staging, dims, months, min_hot_rows), MONTH, "order_id", "order_item_id")
    return refresh_cut(lines, T.WAREHOUSE_DATABASE, "fact_sales", "sales_sk", MONTH, months)


# Everything the tables declare, as checks on the raw tables and the star schema together.
CONSTRAINT_REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "pk_violations": lambda tables: primary_key_report(tables, WAREHOUSE),
    "fk_violations": lambda tables: foreign_key_report(tables, FOREIGN_KEYS),
    "not_null_violations": lambda tables: not_null_report(
        tables, {n: t for n, t in DECLARED.items() if t.required}
    ),
    "length_violations": lambda tables: length_report(tables, DECLARED),
}


class ConstraintError(Exception):
    """The saved star schema breaks its declared constraints."""


def constraint_reports(
    staging: Tables, star: Tables, counts: dict[str, Counts] | None = None
) -> dict[str, DataFrame]:
    """All constraints as reports. With the tables' `counts` those on rows, needed values and sizes read no table."""
    tables = {**staging, **star}
    counted = {}
    if counts:
        counted = counted_reports(next(iter(star.values())).sparkSession, counts, DECLARED)
    return {name: report(tables) for name, report in CONSTRAINT_REPORTS.items() if name not in counted} | counted


def written_counts(spark: SparkSession) -> dict[str, Counts] | None:
    """What was counted while the saved tables were written, if that is known for all of them."""
    places = [(T.STAGING_DATABASE, n) for n in STAGING] + [(T.WAREHOUSE_DATABASE, n) for n in WAREHOUSE]
    found = {name: T.counts_of(spark, database, name) for database, name in places}
    return found if all(found.values()) else None


def save_reports(reports: Tables, prefix: str = "check_", database: str = T.WAREHOUSE_DATABASE) -> dict[str, DataFrame]:
    """Save every report in full, as the table `<prefix><name>`."""
    return {f"{prefix}{name}": T.save_table(df, database, f"{prefix}{name}") for name, df in reports.items()}


def violations(reports: Tables) -> dict[str, int]:
    """Rows of a constraint report that count something wrong, by report; sizes over the declared ones do not stop a load."""
    found = {}
    for name in ("pk_violations", "fk_violations", "not_null_violations"):
        report = reports[f"check_{name}"]
        counts = [F.col(c) > 0 for c in report.columns if c.endswith(("_rows", "_keys"))]
        found[name] = report.where(reduce(Column.__or__, counts)).count()
    return {name: n for name, n in found.items() if n}


def check_star(
    staging: Tables, star: Tables, on_violation: str = "stop", counts: dict[str, Counts] | None = None
) -> dict[str, DataFrame]:
    """Save the constraint reports; stop if a primary key, a foreign key or a needed value is wrong, unless told to `report`."""
    if on_violation not in ("stop", "report"):
        raise ValueError(f"not an option: {on_violation}")
    saved = save_reports(constraint_reports(staging, star, counts))
    wrong = violations(saved)
    if wrong and on_violation == "stop":
        listed = ", ".join(f"{n} in {T.WAREHOUSE_DATABASE}.check_{name}" for name, n in wrong.items())
        raise ConstraintError(f"constraints are broken: {listed}")
    return saved


def save_kpis(star: Tables, orders: DataFrame) -> dict[str, DataFrame]:
    """Save every figure as a small table beside the star schema."""
    frames = kpis.kpi_frames(star, orders)
    return {name: T.save_table(df, T.WAREHOUSE_DATABASE, name) for name, df in frames.items()}


def run(
    spark: SparkSession,
    folder: str,
    on_reject: str = "fail",
    start: datetime.date = CALENDAR_START,
    end: datetime.date = CALENDAR_END,
    ordered: bool = False,
    on_violation: str = "stop",
    by_month: bool = False,
    buckets: int = 0,
) -> dict[str, DataFrame]:
    """Load the CSV files of `folder`, build the star schema, check it and save the figures. May be run again."""
    staging = T.load_all(spark, folder, on_reject, buckets=buckets)
    star = build_warehouse(spark, staging, start, end, ordered, by_month=by_month)
    checks = check_star(staging, star, on_violation, written_counts(spark))
    return {**star, **checks, **save_kpis(star, staging["orders"])}
