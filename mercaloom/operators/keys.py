"""Row numbers without a single-task window."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .skew import MIN_HOT_ROWS, NOT_SKEWED, HotKeys, find_hot_keys
from .storage import materialize

# `monotonically_increasing_id` keeps the partition above this bit and the position below it.
POSITION_BITS = 33
# Ranges of `ranges_by`: as many as the session's shuffle partitions, if a range gets rows between these numbers.
LEAST_RANGE_ROWS, MOST_RANGE_ROWS = 50_000, 1_000_000
# Sampled keys that the bounds of a range come from.
SAMPLE_KEYS_PER_RANGE = 100


def file_part() -> Column:
    """The number that Spark's writer gave to the task that wrote a row's file."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")


def rows_before(stored: DataFrame) -> list[int]:
    """For the files of a written table, by the number of their task, how many rows lie in those before.

    The driver sees one count per file. One task writes one file (`ONE_FILE`).
    """
    sizes = dict(stored.groupBy(file_part().alias("part")).count().collect())
    return list(accumulate((sizes.get(p, 0) for p in range(max(sizes, default=0))), initial=0))


def number_stored(stored: DataFrame, name: str) -> DataFrame:
    """1..n in the order of a written table's files and of the rows inside them, as column `name`.

    A number is a row's place in its file, which the reader knows, plus the rows of the files before, held as a constant
    array. Nothing is written again, and a query that does not use the numbers does not compute them.
    """
    offsets = F.split(F.lit(",".join(map(str, rows_before(stored)))), ",").cast("array<bigint>")
    number = F.element_at(offsets, file_part() + 1) + F.col("_metadata.row_index") + 1
    return stored.select(number.alias(name), *map(X.column, stored.columns))


def sorted_ranges(df: DataFrame, *order: str) -> DataFrame:
    """All rows in order, over partitions and inside them, by one range shuffle.

    The last range column is the source partition: rows that tie on all order columns would otherwise share one range
    however many they are.
    """
    return (
        df.withColumn("_tie", F.spark_partition_id())
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
    )


def range_number(key: Column, bounds: list) -> Column:
    """Which range a key lies in, from 0: how many bounds are below it; null lies in range 0.

    The bounds stand in runs of about their root in number, so a row compares itself with two short lists only.
    """
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    firsts = F.array(*(F.lit(run[0]) for run in runs))
    lists = F.array(*(F.array(*map(F.lit, run)) for run in runs))
    run = F.size(F.filter(firsts, lambda c: c < key))
    inside = F.size(F.filter(F.element_at(lists, run), lambda c: c < key))
    return F.when(key.isNull() | (run == 0), 0).otherwise((run - 1) * step + inside).cast("int")


def ranges_by(keys: DataFrame, df: DataFrame, first: str, *rest: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """`sorted_ranges(df, first, *rest)` with bounds from `keys`, where the column `first` is at hand.

    A range shuffle samples its input first, so whatever makes `df` would run twice; here it runs once. The bounds cut the
    keys of a sample; they decide which task sorts a row and never its place. A key that would overfill a range makes it
    the plain range shuffle.
    """
    keys = keys.select(first)
    if find_hot_keys(keys, first, min_rows=min_rows)[first]:
        return sorted_ranges(df, first, *rest)
    total, tasks = keys.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(tasks, total // LEAST_RANGE_ROWS), total // MOST_RANGE_ROWS)
    bounds = []
    if parts > 1:
        sampled = keys.where(F.col(first).isNotNull()).sample(min(1.0, SAMPLE_KEYS_PER_RANGE * parts / total), seed=0)
        found = [row[0] for row in sampled.orderBy(first).collect()]
        bounds = list(dict.fromkeys(found[i * len(found) // parts] for i in range(1, parts))) if found else []
    ranged = df.withColumn("_range", range_number(F.col(first), bounds))
    return ranged.repartitionById(parts, F.col("_range")).sortWithinPartitions(first, *rest).drop("_range")


def ordered_row_number(df: DataFrame, name: str, *order: str) -> DataFrame:
    """`row_number() over (order by ...)` as column `name`, numbered in parallel.

    One range shuffle sorts the rows; they are stored, and numbered from the files. So numbers cannot change when a
    task is run again.
    """
    return number_stored(materialize(sorted_ranges(df, *order), name), name)


def row_identity(df: DataFrame, name: str) -> DataFrame:
    """1..n without gaps in no particular order, as an identity column gives; no shuffle."""
    return number_stored(materialize(df, name), name)


def grouped_row_number(
    df: DataFrame, name: str, group: str, *order: str, hot: HotKeys = NOT_SKEWED
) -> DataFrame:
    """`row_number() over (partition by group order by ...)`, also when a group fills many tasks.

    Ordinary groups use the window. Hot groups are numbered together in order, and each row then
    takes the distance to the first number of its group.
    """
    window = Window.partitionBy(group).orderBy(*order)
    if not hot:
        return df.withColumn(name, F.row_number().over(window)).select(name, *df.columns)
    missing, listed = F.col(group).isNull(), list(hot.spread)
    is_hot = F.when(missing, F.lit(hot.null_spread > 1)).otherwise(F.col(group).isin(listed) if listed else F.lit(False))
    small = df.where(~is_hot).withColumn(name, F.row_number().over(window).cast("long"))
    numbered = ordered_row_number(df.where(is_hot), "_number", group, *order)
    first = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_number").alias("_first"))
    large = numbered.join(  # one row per hot key on the broadcast side
        F.broadcast(first), F.col(group).eqNullSafe(F.col("_group"))
    ).withColumn(name, F.col("_number") - F.col("_first") + 1)
    return small.select(name, *df.columns).unionByName(large.select(name, *df.columns))
