"""Exploratory statistics: sizes, missing values, frequencies, coverage, summaries."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dataset_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table."""
    return _union(
        [
            df.agg(
                F.lit(name).alias("dataset"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
            )
            for name, df in tables.items()
        ]
    )


def table_info(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count, and the name and type of each column."""
    parts = []
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(column).alias("column_name"),
                    F.lit(dtype).alias("data_type"),
                )
                for i, (column, dtype) in enumerate(df.dtypes, start=1)
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(
            counted.select(F.lit(name).alias("table_name"), "row_count", F.inline(columns))
        )
    return _union(parts)


def missing_values(df: DataFrame) -> DataFrame:
    """Missing cells of every column, as a count and as a percentage, in one pass."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(X.column(c).isNull()).alias(c) for c in df.columns],
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), X.column(c).alias("missing_count"))
            for c in df.columns
        ]
    )
    share = F.try_divide(
        F.col("missing_count").cast("double") * 100, F.col("_rows").cast("double")
    )
    return row.select("_rows", F.inline(cells)).select(
        "column_name", "missing_count", F.bround(share, 2).alias("missing_percentage")
    )


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_values(df).where("missing_count > 0")


def missing_totals(df: DataFrame, name: str) -> DataFrame:
    """Missing cells of a whole table and the number of columns that have any."""
    return missing_values(df).agg(
        F.lit(name).alias("table_name"),
        F.sum("missing_count").alias("missing_cells"),
        F.count_if(F.col("missing_count") > 0).alias("columns_with_missing"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every value that is present, most frequent first."""
    return (
        df.where(X.column(column).isNotNull())
        .groupBy(X.column(column))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), X.column(column))
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).limit(n)


def key_coverage(
    child: DataFrame, parent: DataFrame, key: str, in_child: str, in_parent: str
) -> DataFrame:
    """Distinct keys on both sides, from one shuffle of the keys of the two tables together."""
    tagged = child.select(key, F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        parent.select(key, F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    present = tagged.where(F.col(key).isNotNull())
    keys = present.groupBy(key).agg(F.max("c").alias("c"), F.max("p").alias("p"))
    return keys.agg(
        F.count_if(F.col("c") == 1).alias(in_child), F.count_if(F.col("p") == 1).alias(in_parent)
    )


def with_difference(coverage: DataFrame, in_child: str, in_parent: str, name: str) -> DataFrame:
    """Adds parent keys minus child keys. An orphan child key lowers it, unlike an anti-join."""
    return coverage.withColumn(name, F.col(in_parent) - F.col(in_child))


def key_uniqueness(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table beside the distinct values of its keys."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(k).alias(f"unique_{k}s") for k in keys],
    )


def group_size_summary(df: DataFrame, key: str) -> DataFrame:
    """Mean and largest number of rows per key."""
    sizes = df.where(X.column(key).isNotNull()).groupBy(X.column(key)).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.avg("size").alias("avg_rows"), F.max("size").alias("max_rows"))


# A bracket around a quartile that holds at most this many rows is sorted; a larger one is narrowed first.
BRACKET_ROWS = 1_000_000
# How far, as a share of the rows, the first brackets reach to either side; their estimate is ten times finer.
REACH = 0.001
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


@dataclass
class _Bracket:
    """Values between which a quartile lies, and the rows below and inside; `place` is its place among all rows."""

    place: float
    low: float
    high: float
    below: int = 0
    inside: int = 0

    def holds(self) -> bool:
        return self.below <= math.floor(self.place) and math.ceil(self.place) < self.below + self.inside

    def has(self, v: Column) -> Column:
        return (v >= self.low) & (v <= self.high)


def _brackets(values: DataFrame, rows: int, least: float, most: float) -> list[_Bracket]:
    """A small bracket around each quartile, from a few passes that shuffle next to nothing."""
    v = F.col("v")

    def near(v: Column, share: float, reach: float) -> Column:
        ends = [max(0.0, share - reach), min(1.0, share + reach)]
        return F.percentile_approx(v, ends, math.ceil(10 / REACH))

    found = values.agg(*(near(v, share, REACH) for share in QUARTILES.values())).first()
    brackets = [_Bracket((rows - 1) * share, *ends) for share, ends in zip(QUARTILES.values(), found)]
    while True:
        counts = values.agg(*(F.count_if(x) for b in brackets for x in (v < b.low, b.has(v)))).first()
        wide = []
        for b, below, inside in zip(brackets, counts[::2], counts[1::2]):
            b.below, b.inside = below, inside
            if not b.holds():  # the estimate was off: take all values and narrow again
                b.low, b.high, b.below, b.inside = least, most, 0, rows
            if b.inside > BRACKET_ROWS and b.low < b.high:
                wide.append(b)
        if not wide:
            return brackets
        ends = [near(F.when(b.has(v), v), (b.place - b.below) / b.inside, REACH) for b in wide]
        for b, (low, high) in zip(wide, values.agg(*ends).first()):
            b.low, b.high = (low, high) if (low, high) != (b.low, b.high) else ((low + high) / 2, high)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles with linear interpolation.

    Estimated quantiles bracket each quartile; counting the rows below and inside proves a bracket right, and only the
    values inside are grouped and put in order. Nothing is stored.
    """
    spark = df.sparkSession
    values = df.select(X.column(column).cast("double").alias("v")).where("v is not null")
    stats = values.agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    count, mean, std, least, most = stats.first()
    fixed = {"count": F.lit(count).cast("long"), **{n: F.lit(x).cast("double") for n, x in (("mean", mean), ("std", std), ("min", least), ("max", most))}}
    order = ("count", "mean", "std", "min", *QUARTILES, "max")
    if not count:
        return spark.range(0, 1, 1, 1).select(*(fixed.get(c, F.lit(None).cast("double")).alias(c) for c in order))
    brackets = _brackets(values, count, least, most)
    marks = F.array_compact(F.array(*(F.when(b.has(F.col("v")), i) for i, b in enumerate(brackets))))
    inside = values.select("v", F.explode(marks).alias("q")).groupBy("q", "v").agg(F.count("*").alias("n"))
    before = Window.partitionBy("q").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def at(i: int, rank: int) -> Column:
        rank -= brackets[i].below
        return F.max(F.when((F.col("q") == i) & (F.col("first") <= rank) & (rank < F.col("first") + F.col("n")), F.col("v")))

    quartiles = {}
    for i, (name, b) in enumerate(zip(QUARTILES, brackets)):
        low, high = at(i, math.floor(b.place)), at(i, math.ceil(b.place))
        quartiles[name] = low + (high - low) * (b.place - math.floor(b.place))
    return placed.agg(*((quartiles[c] if c in quartiles else F.first(fixed[c])).alias(c) for c in order))
