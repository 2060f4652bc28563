"""Checks for references, keys, required columns and declared lengths."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..sources.schemas import ForeignKey, Table

Tables = Mapping[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent row, with their number of rows. A NULL key has no parent.

    Both sides shrink to one row per key before they are shuffled, so the anti-join meets every key
    once, however many rows share it.
    """
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.join(parent.select(key).distinct(), key, "left_anti")


def unreferenced_count(parent: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """Number of parent rows that no child row names."""
    return orphan_counts(parent, child, key).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias(name))


def missing_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_if(X.column(column).isNull()).alias(name))


# The reference checks of the raw tables, by name.
INTEGRITY_CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    "orphan_payments": lambda t: orphan_counts(t["payments"], t["orders"], "order_id"),
    "orphan_order_items": lambda t: orphan_counts(t["order_items"], t["orders"], "order_id"),
    "orphan_reviews": lambda t: orphan_counts(t["reviews"], t["orders"], "order_id"),
    "inactive_sellers": lambda t: unreferenced_count(
        t["sellers"], t["order_items"], "seller_id", "inactive_sellers"
    ),
    "unsold_products": lambda t: unreferenced_count(
        t["products"], t["order_items"], "product_id", "unsold_products"
    ),
    "missing_zip": lambda t: missing_count(
        t["customers"], "customer_zip_code_prefix", "missing_zip_count"
    ),
    "customers_without_orders": lambda t: unreferenced_count(
        t["customers"], t["orders"], "customer_id", "orphan_customers"
    ),
}


def check_integrity(staging: Tables) -> dict[str, DataFrame]:
    return {name: check(staging) for name, check in INTEGRITY_CHECKS.items()}


def primary_key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their number of rows."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.where((F.col("cnt") > 1) | F.col(key).isNull())


def primary_key_report(tables: Tables, declared: dict[str, Table]) -> DataFrame:
    parts = []
    for name, table in declared.items():
        bad = primary_key_violations(tables[name], table.key)
        missing = F.col(table.key).isNull()
        parts.append(
            bad.agg(
                F.lit(name).alias("table_name"),
                F.lit(table.key).alias("key_column"),
                F.count_if(~missing).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(missing, F.col("cnt"))), F.lit(0)).alias("null_rows"),
            )
        )
    return _union(parts)


def foreign_key_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child key values that the parent does not have, with their rows. NULL refers to nothing."""
    counted = child.where(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("cnt")).join(
        parent.select(F.col(parent_column).alias(column)), column, "left_anti"
    )


def foreign_key_report(tables: Tables, keys: tuple[ForeignKey, ...]) -> DataFrame:
    parts = []
    for fk in keys:
        bad = foreign_key_violations(
            tables[fk.child], fk.column, tables[fk.parent], fk.parent_column
        )
        parts.append(
            bad.agg(
                F.lit(fk.child).alias("table_name"),
                F.lit(fk.column).alias("column_name"),
                F.lit(fk.parent).alias("parent_table"),
                F.count(F.lit(1)).alias("unknown_keys"),
                F.coalesce(F.sum("cnt"), F.lit(0)).alias("unknown_rows"),
            )
        )
    return _union(parts)


def not_null_violations(df: DataFrame, table: Table) -> DataFrame:
    """Rows that lack a value, for every required column, in one pass."""
    row = df.agg(*[F.count_if(X.column(c).isNull()).alias(c) for c in table.required])
    found = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), X.column(c).alias("null_rows"))
            for c in table.required
        ]
    )
    return row.select(F.lit(table.name).alias("table_name"), F.inline(found))


def not_null_report(tables: Tables, declared: dict[str, Table]) -> DataFrame:
    return _union([not_null_violations(tables[n], t) for n, t in declared.items()])


def _too_large(table: Table) -> dict[str, Column]:
    return {
        c.name: F.length(X.column(c.name)) > c.max_length
        if c.max_length
        else F.abs(X.column(c.name)) >= F.lit(10**c.digits)
        for c in table.limited
    }


def length_violations(df: DataFrame, table: Table) -> DataFrame:
    """Rows outside the declared text length or number of digits, in one pass."""
    limited = table.limited
    row = df.agg(*[F.count_if(bad).alias(name) for name, bad in _too_large(table).items()])
    found = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("column_name"),
                F.lit(c.max_length or c.digits).alias("declared_size"),
                X.column(c.name).alias("too_large_rows"),
            )
            for c in limited
        ]
    )
    return row.select(F.lit(table.name).alias("table_name"), F.inline(found))


def length_report(tables: Tables, declared: dict[str, Table]) -> DataFrame:
    return _union([length_violations(tables[n], t) for n, t in declared.items() if t.limited])


def write_counts(table: Table, which: Column | None = None) -> list[Column]:
    """What the reports on rows, needed values and sizes count, as aggregates to observe while the rows (those of `which`) are
    written."""
    kept = F.lit(True) if which is None else which
    counts = {"rows": kept}
    counts |= {f"null {c}": kept & X.column(c).isNull() for c in table.required}
    counts |= {f"large {c}": kept & bad for c, bad in _too_large(table).items()}
    return [F.count_if(condition).alias(name) for name, condition in counts.items()]


# Counts of one table as they were observed, by the names that `write_counts` gives them.
Counts = dict[str, int]


def counted_reports(
    spark: SparkSession, counts: dict[str, Counts], declared: dict[str, Table]
) -> dict[str, DataFrame]:
    """The load, needed-value and length reports from counts made while the tables were written; reads no table."""
    nulls = [(n, c, counts[n][f"null {c}"]) for n, t in declared.items() for c in t.required]
    sizes = [
        (n, c.name, c.max_length or c.digits, counts[n][f"large {c.name}"]) for n, t in declared.items() for c in t.limited
    ]
    rows = [(n, counts[n]["rows"]) for n in declared]
    return {
        "load_report": spark.createDataFrame(rows, "table_name string, rows_loaded long"),
        "not_null_violations": spark.createDataFrame(nulls, "table_name string, column_name string, null_rows long"),
        "length_violations": spark.createDataFrame(
            sizes, "table_name string, column_name string, declared_size int, too_large_rows long"
        ),
    }
