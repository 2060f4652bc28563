"""Every job as a named query over a folder of test tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explore as E
from ..operators import integrity as I
from ..operators.profile import profile, profile_all
from ..sources.fixtures import StagingTables, read_source_tables
from ..sources.schemas import FOREIGN_KEYS, STAGING
from ..sources.tables import load_report
from . import fact, kpis
from .dimensions import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_dim_seller,
    order_calendar,
)
from .pipeline import CONSTRAINT_REPORTS, build_star

# The test orders lie between these days, outside the default calendar.
TEST_CALENDAR = (datetime.date(1995, 1, 1), datetime.date(2002, 12, 31))

Query = Callable[[SparkSession, str], DataFrame]


class Workspace:
    """The raw tables of one folder and, once asked for, the star schema built from them.

    The star is stored in the shared folder, as a warehouse is saved once and then read by all
    figures and checks.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def staging(self) -> StagingTables:
        return StagingTables(read_source_tables(self.spark, self.folder))

    @cached_property
    def calendar(self) -> DataFrame:
        return build_dim_date(self.spark, *TEST_CALENDAR)

    def new_star(self, ordered: bool) -> dict[str, DataFrame]:
        return build_star(self.staging, self.calendar, ordered)

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return self.new_star(ordered=False)


def _input_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the input tables; a changed input is a new workspace."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)


class Workspaces:
    """The workspaces of one run."""

    def __init__(self):
        self._known: dict[tuple, Workspace] = {}

    def get(self, spark: SparkSession, folder: str) -> Workspace:
        version = _input_version(spark, folder)
        key = (spark.sparkContext.applicationId, folder, version)
        return self._known.setdefault(key, Workspace(spark, folder))


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Means depend on the order of addition in the last digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def queries(workspaces: Workspaces | None = None) -> dict[str, Query]:
    known = workspaces or Workspaces()

    def on_workspace(job: Callable[[Workspace], DataFrame]) -> Query:
        return lambda spark, folder: job(known.get(spark, folder))

    def staged(job: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
        return on_workspace(lambda w: job(w.staging))

    def starred(job: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
        return on_workspace(lambda w: job(w.star))

    def profiled(name: str) -> Query:
        return staged(lambda s: _rounded(profile(s[name], name), "avg_val"))

    def integrity(name: str) -> Query:
        return staged(I.INTEGRITY_CHECKS[name])

    def constraint(name: str) -> Query:
        return on_workspace(lambda w: CONSTRAINT_REPORTS[name]({**w.staging, **w.star}))

    def coverage(child: str, parent: str, key: str, *names: str) -> Query:
        def job(s: Mapping[str, DataFrame]) -> DataFrame:
            counted = E.key_coverage(s[child], s[parent], key, *names[:2])
            return E.with_difference(counted, *names) if len(names) > 2 else counted

        return staged(job)

    def missing(name: str) -> Query:
        return staged(lambda s: E.columns_with_missing(s[name]))

    def missing_summary(s: Mapping[str, DataFrame]) -> DataFrame:
        return E.missing_totals(s["orders"], "orders").unionByName(
            E.missing_totals(s["products"], "products")
        )

    def calendar_of_orders(s: Mapping[str, DataFrame]) -> DataFrame:
        """The days from the first to the last purchase."""
        return order_calendar(s["orders"]).select("date_key", "full_date")

    def shown_calendar(s: Mapping[str, DataFrame]) -> DataFrame:
        moment = F.date_format("first_purchase", "yyyy-MM-dd HH:mm:ss")
        return order_calendar(s["orders"]).select(
            "date_key", "full_date", moment.alias("first_purchase"), F.col("any_canceled").cast("int")
        )

    def profiled_calendar(s: Mapping[str, DataFrame]) -> DataFrame:
        """A whole number, a day, a moment and a truth value."""
        return _rounded(profile(order_calendar(s["orders"]), "order_calendar"), "avg_val")

    def default_calendar(w: Workspace) -> DataFrame:
        tables = {**w.star, "dim_date": build_dim_date(w.spark)}
        return I.foreign_key_report(tables, FOREIGN_KEYS)

    def sales_key_check(star: Mapping[str, DataFrame]) -> DataFrame:
        return star["fact_sales"].agg(
            F.min("sales_sk").alias("first_key"),
            F.max("sales_sk").alias("last_key"),
            F.count_distinct("sales_sk").alias("distinct_keys"),
        )

    described = ("orders", "order_items", "customers", "products")

    return {
        # star schema
        "dim_date": staged(calendar_of_orders),
        "profile_dim_date": staged(lambda s: _rounded(profile(calendar_of_orders(s), "dim_date"), "avg_val")),
        "order_calendar": staged(shown_calendar),
        "profile_order_calendar": staged(profiled_calendar),
        "dim_customer": staged(lambda s: build_dim_customer(s["customers"])),
        "dim_seller": staged(lambda s: build_dim_seller(s["sellers"])),
        "dim_product": staged(
            lambda s: build_dim_product(s["products"], s["category_translation"])
        ),
        "payment_per_order": staged(lambda s: fact.payment_per_order(s["payments"])),
        "review_per_order": staged(lambda s: fact.review_per_order(s["reviews"])),
        "fact_sales": on_workspace(lambda w: w.new_star(ordered=True)["fact_sales"]),
        "sales_key_check": starred(sales_key_check),
        # integrity
        **{name: integrity(name) for name in I.INTEGRITY_CHECKS},
        # column profiles
        **{f"profile_{name}": profiled(name) for name in STAGING},
        "profile_all": staged(
            lambda s: _rounded(profile_all({n: s[n] for n in STAGING}), "avg_val")
        ),
        # declared constraints
        **{name: constraint(name) for name in CONSTRAINT_REPORTS},
        "fk_violations_default_calendar": on_workspace(default_calendar),
        # exploration
        "load_report": on_workspace(lambda w: load_report({**w.staging, **w.star})),
        "dataset_overview": staged(lambda s: E.dataset_overview({n: s[n] for n in STAGING})),
        "table_info": staged(lambda s: E.table_info({n: s[n] for n in described})),
        **{f"missing_{name}": missing(name) for name in described},
        "missing_summary": staged(missing_summary),
        "order_status_counts": staged(lambda s: E.value_counts(s["orders"], "order_status")),
        "top_states": staged(lambda s: E.top_values(s["customers"], "customer_state")),
        "top_categories": staged(lambda s: E.top_values(s["products"], "product_category_name")),
        "price_describe": staged(
            lambda s: _rounded(
                E.describe(s["order_items"], "price"),
                *("mean", "std", "min", "p25", "p50", "p75", "max"),
            )
        ),
        "items_per_order": staged(
            lambda s: _rounded(
                E.group_size_summary(s["order_items"], "order_id"), "avg_rows", digits=2
            )
        ),
        "orders_without_items": coverage(
            "order_items",
            "orders",
            "order_id",
            *("orders_with_items", "total_orders", "orders_without_items"),
        ),
        "products_never_sold": coverage(
            "order_items",
            "products",
            "product_id",
            *("products_sold", "total_products", "products_never_sold"),
        ),
        "customers_with_orders": coverage(
            "orders", "customers", "customer_id", "customers_with_orders", "total_customers"
        ),
        "active_sellers": coverage(
            "order_items", "sellers", "seller_id", "active_sellers", "total_sellers"
        ),
        "order_key_coverage": coverage(
            "order_items", "orders", "order_id", "order_ids_in_items", "order_ids_in_orders"
        ),
        "customer_key_check": staged(
            lambda s: E.key_uniqueness(s["customers"], "customer_id", "customer_unique_id")
        ),
        # figures
        "kpi_revenue_lines": starred(kpis.revenue_lines),
        "kpi_orders": staged(lambda s: kpis.total_orders(s["orders"])),
        "kpi_top_category": starred(kpis.top_category),
        "kpi_top_state": starred(kpis.top_state),
        "kpi_delivery": starred(
            lambda t: _rounded(kpis.delivery_time(t), "avg_days_line", "avg_days_order")
        ),
        "kpi_late_rate": starred(
            lambda t: _rounded(kpis.late_rate(t), "late_rate_line", "late_rate_order")
        ),
        "kpi_values": starred(
            lambda t: _rounded(kpis.order_values(t), "avg_line_value", "avg_order_value")
        ),
        "revenue_by_category_state": starred(kpis.revenue_by_category_state),
        "revenue_by_month": starred(kpis.revenue_by_month),
    }
