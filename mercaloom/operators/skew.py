"""Equi-joins that survive a key holding a large share of all rows."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# A key below this many rows never makes a task too large, whatever its share.
MIN_HOT_ROWS = 1_000_000
# A key is hot above this many fair shares of a task, so there are at most half as many hot keys as tasks.
HOT_TASKS = 2
# Sampled rows per task that keys are judged by; a hot key has some 400 of them.
SAMPLE_ROWS_PER_TASK = 200
# A parent is broadcast up to this size, as measured: its texts and numbers and a fixed part per row.
BROADCAST_BYTES = 256 << 20
ROW_BYTES = 40


@dataclass(frozen=True)
class HotKeys:
    """The heavy values of one column, each with the number of tasks to spread it over."""

    spread: dict = field(default_factory=dict)
    null_spread: int = 1

    def __bool__(self) -> bool:
        return bool(self.spread) or self.null_spread > 1


@dataclass(frozen=True)
class Lookup:
    """A parent to be joined. `measurable` says that measuring it is cheap."""

    key: str
    parent: DataFrame
    how: str = "inner"
    measurable: bool = True


NOT_SKEWED = HotKeys()


def find_hot_keys(
    df: DataFrame, *columns: str, min_rows: int = MIN_HOT_ROWS
) -> dict[str, HotKeys]:
    """Keys of each column that hold a large share of the rows.

    A table with fewer than `min_rows` rows has none and is only counted. Otherwise the keys of a
    sample are counted, column by column, so each pass reads one column and shuffles little. The
    driver sees at most half as many keys per column as there are tasks. They decide how the work is spread and never what
    a join returns, so a key the sample misses costs time and not rows.
    """
    total = df.count()
    if total < min_rows:
        return dict.fromkeys(columns, NOT_SKEWED)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fair_share = max(total / tasks, 1)
    fraction = min(1.0, max(SAMPLE_ROWS_PER_TASK * tasks, min_rows) / total)
    floor = max(min_rows, HOT_TASKS * fair_share)
    hot = {}
    for c in columns:
        keys = df.select(c)
        sampled = keys if fraction == 1 else keys.sample(fraction, seed=0)
        counted = sampled.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        spread = {
            key: max(2, math.ceil(n / fraction / fair_share))
            for key, n in counted.where(F.col("n") >= floor * fraction).collect()
        }
        hot[c] = HotKeys(null_spread=spread.pop(None, 1), spread=spread)
    return hot


def skew_safe_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: HotKeys = NOT_SKEWED
) -> DataFrame:
    """`left.join(right, key, how)` for inner and left joins whose left side may be skewed.

    Without hot keys this is the plain join: Spark broadcasts the right side when its measured size
    allows and shuffles otherwise. With hot keys, a hot left row goes to one of the key's slots and
    the matching right rows are repeated in every slot, so each pair still meets exactly once. The
    slot depends on the row and on its input partition, both the same when a task runs again, and
    identical copies of a row spread too. The slot counts add up to at most the number of shuffle
    partitions plus two per hot key, which bounds the repetition.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"not supported: {how}")
    if not (hot if how == "left" else hot.spread):  # an inner join drops rows without a key
        return left.join(right, key, how)

    slots = F.broadcast(  # one row per hot key
        left.sparkSession.createDataFrame(
            list(hot.spread.items()),
            StructType([left.schema[key], StructField("_slots", IntegerType())]),
        )
    )
    # Rows without a key match nothing; a left join keeps them, so they are spread as well.
    slot_count = F.when(F.col(key).isNull(), hot.null_spread).otherwise(
        F.coalesce("_slots", F.lit(1))
    )
    place = F.xxhash64(*left.columns, "_source_partition")
    salted_left = (
        left.withColumn("_source_partition", F.spark_partition_id())
        .join(slots, key, "left")
        .withColumn("_slot", F.pmod(place, slot_count).cast("int"))
        .drop("_slots", "_source_partition")
    )
    salted_right = (
        right.join(slots, key, "left")
        .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)))
        .drop("_slots")
    )
    return salted_left.join(salted_right, [key, "_slot"], how).drop("_slot")


def measured_bytes(df: DataFrame) -> int:
    """About the memory the rows of `df` take: their texts, their fixed-width values and a part per row."""
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    fixed = ROW_BYTES + 8 * len(df.columns)
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in texts]
    rows, *sums = df.agg(F.count(F.lit(1)), *lengths).first()
    return rows * fixed + sum(sums)


def look_up(
    left: DataFrame,
    *lookups: Lookup,
    min_rows: int = MIN_HOT_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join parents one after another. Those of at most `broadcast_bytes`, as measured, are broadcast, which no hot key
    can disturb; for the others the hot keys of `left` decide how the join is spread."""
    if broadcast_bytes is None:
        broadcast_bytes = BROADCAST_BYTES
    small = [lookup.measurable and measured_bytes(lookup.parent) <= broadcast_bytes for lookup in lookups]
    shuffled = {lookup.key for lookup, is_small in zip(lookups, small) if not is_small}
    hot = find_hot_keys(left, *sorted(shuffled), min_rows=min_rows) if shuffled else {}
    for lookup, is_small in zip(lookups, small):
        if is_small:
            left = left.join(F.broadcast(lookup.parent), lookup.key, lookup.how)
        else:
            left = skew_safe_join(left, lookup.parent, lookup.key, lookup.how, hot[lookup.key])
    return left
