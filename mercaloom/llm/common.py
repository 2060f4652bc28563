"""What the operators share: reading, slicing long batches, stored tables, ranges of a key, joins that bear hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import range_number  # noqa: F401
from ..operators.storage import shared_folder

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1000
# A table is broadcast only if it was counted and has no more rows than this (narrow rows, some tens of MB).
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Rows that travel to Python hold whole texts, so fewer of them make a batch than Spark's 10,000."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    folder, application = shared_folder(spark).rstrip("/"), spark.sparkContext.applicationId
    return f"{folder}/mercaloom/{application}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back, so that lost executors change nothing."""
    path = shared_path(df.sparkSession, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Stored tables that are dropped together, once what was read from them is stored itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_path(self.spark, label)
        self.paths.append(path)
        df.write.options(compression="zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for name in self.paths:
            drop_path(self.spark, name)
        self.paths = []


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a cut hold about `limit` bytes; a longer text stands alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def gathered(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """As `slices`, with small neighbours put together up to the limit."""
    held, total = [], 0
    for part in slices(batches, text, limit):
        if held and total + part.nbytes > limit:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(part)
        total += part.nbytes
    if held:
        yield pa.concat_batches(held)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most `parts - 1` values that cut the key into ranges of about equal counts; reads the key only."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(key, shares, 10 * parts)).first()
    return sorted(set(row[0] or []))


def join_counted(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Left rows with the right row of their key (left outer), whatever share of the left one key holds.

    `right` has one row per key and in `weight` how many left rows have it. Keys with more than 1/1000 of `total`
    are at most 1000, so they are broadcast; their left rows stay where they are spread, and only the rest is
    shuffled by key.
    """
    names = [c for c in right.columns if c != key]
    hot = right.where(F.col(weight) * 1000 > total).select(
        F.col(key).alias("_hot_key"), F.struct(*names).alias("_hot")
    )
    cold = right.where(F.col(weight) * 1000 <= total).select(
        F.col(key).alias("_cold_key"), F.struct(*names).alias("_cold")
    )
    marked = left.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    # a hot row is dealt under a spread that no cold key has, so it meets none
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(1 << 20)).cast("int") + 1
    marked = marked.withColumn("_spread", F.when(F.col("_hot_key").isNull(), F.lit(0)).otherwise(spread))
    cold = cold.withColumn("_cold_spread", F.lit(0))
    joined = marked.join(cold, (F.col("_spread") == F.col("_cold_spread")) & (F.col(key) == F.col("_cold_key")), "left")
    both = [F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in names]
    return joined.select(*left.columns, *both)


def matches_counted(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """As `join_counted` without the left rows that meet none, and with a key that is a whole number and not null.

    Rows without a partner leave the join instead of being filtered after it. The left rows of the at most 1000 hot
    keys are dealt over as many places as the shuffle has, and so is each such right row.
    """
    names = [c for c in right.columns if c != key]
    hot = [r[0] for r in right.where(F.col(weight) * 1000 > total).select(key).collect()]
    places = shuffle_parts(left.sparkSession)
    spread = lambda of, cold: F.when(F.col(key).isin(hot), of).otherwise(cold) if hot else cold
    dealt = left.withColumn("_place", spread(F.pmod(F.xxhash64(*left.columns), F.lit(places)).cast("int"), F.lit(0)))
    every = F.explode(spread(F.sequence(F.lit(0), F.lit(places - 1)), F.array(F.lit(0))))
    repeated = right.select(F.col(key).alias("_key"), *names, every.alias("_at"))
    joined = dealt.join(repeated, (F.col("_place") == F.col("_at")) & (F.col(key) == F.col("_key")))
    return joined.select(*left.columns, *names)
