"""Databases and saved tables: full-refresh loads, listings and row counts.

A table is the content of one folder, `<name>__<number>`, below its database's location. A new content is written to a
new folder, then the table is pointed at it, the folder is marked, and older ones go. So a write that fails leaves the old
rows where they are, and a session whose catalog does not know the table yet can replace it all the same. Only marked
folders that the table no longer names are deleted: of two sessions that save a table at once, neither deletes what the
other is writing or has just pointed the table at, and the later one wins. `drop_unfinished` clears what failed writers left.

What the reports on rows, needed values and sizes count is observed while rows are written and kept as a property of the
table, so these reports read no table again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.integrity import Counts, write_counts
from ..operators.keys import rows_before
from ..operators.storage import ONE_FILE
from .csv_files import FILE_PATTERNS, REJECT_COLUMNS, accepted, header_of, parse, prepare, rejected
from .csv_records import put_together, read_pieces, split_starts
from .schemas import STAGING, Table

STAGING_DATABASE = "staging"
WAREHOUSE_DATABASE = "warehouse"


class LoadError(Exception):
    """A table was not loaded; its previous content is untouched."""


def create_databases(spark: SparkSession) -> None:
    for database in (STAGING_DATABASE, WAREHOUSE_DATABASE):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _new_folder(spark: SparkSession, database: str, name: str) -> str:
    location = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{location}/{name}__{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


@dataclass(frozen=True)
class Buckets:
    """Rows dealt by the hash of `key` into `number` sorted files, which a join or a group by `key` reads without a shuffle."""

    key: str
    number: int


# The tables that the fact joins by order.
BUCKET_KEYS = dict.fromkeys(("orders", "order_items", "payments", "reviews"), "order_id")


def _bucket_number(spark: SparkSession, table: str) -> int:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(found.data_type) if found else 0


def _point(
    spark: SparkSession, database: str, name: str, schema: StructType, folder: str, buckets: Buckets | None = None
) -> DataFrame:
    """Make `folder` the content of the table; the folder it had is left alone."""
    table = f"{database}.`{name}`"
    path, files = _path(spark, folder)
    files.mkdirs(path)  # no rows, no folder
    bare = StructType([field for field in schema])
    if spark.catalog.tableExists(f"{database}.{name}"):
        found = spark.catalog.getTable(f"{database}.{name}")
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in bare]
        dealt = _bucket_number(spark, table) == (buckets.number if buckets else 0)
        if found.tableType == "EXTERNAL" and same and dealt:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP {'VIEW' if found.tableType == 'VIEW' else 'TABLE'} {table}")
    if buckets:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bare)
        dealt = f"CLUSTERED BY (`{buckets.key}`) SORTED BY (`{buckets.key}`) INTO {buckets.number} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {dealt} LOCATION '{folder}'")
    else:
        spark.catalog.createTable(f"{database}.{name}", path=folder, source="parquet", schema=bare)
    return spark.table(table)


# An empty file in a folder that a table has been pointed at.
MARK = "_pointed"
COUNTS = "mercaloom.counts"


def _contents(spark: SparkSession, folder: str) -> list:
    """The folders of all contents of a table, finished or not, with whether they are marked."""
    path, files = _path(spark, folder)
    stem, Path = path.getName().rpartition("__")[0], spark._jvm.org.apache.hadoop.fs.Path
    found = [s for s in files.listStatus(path.getParent()) or () if s.getPath().getName().rpartition("__")[0] == stem]
    return [(s, files.exists(Path(s.getPath(), MARK))) for s in found]


def _drop_others(spark: SparkSession, database: str, name: str, folder: str) -> None:
    """Mark the content that the table has been pointed at and delete earlier ones, also those of other sessions."""
    path, files = _path(spark, folder)
    files.create(spark._jvm.org.apache.hadoop.fs.Path(path, MARK)).close()
    # Listed first, asked second: a folder that was marked by then and is not named now has been replaced.
    marked = [status.getPath() for status, is_marked in _contents(spark, folder) if is_marked]
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.`{name}`").collect()
    named = " ".join(row.data_type for row in described if row.col_name in ("Location", "View Text"))
    for old in marked:
        if old.getName() not in named:
            files.delete(old, True)


def drop_unfinished(spark: SparkSession, database: str, name: str, before_ms: int) -> int:
    """Delete contents of a table that were never finished and not touched since `before_ms` (epoch); how many."""
    folder = _new_folder(spark, database, name)
    path, files = _path(spark, folder)
    old = [s for s, is_marked in _contents(spark, folder) if not is_marked and s.getModificationTime() < before_ms]
    for status in old:
        files.delete(status.getPath(), True)
    return len(old)


def _keep_counts(spark: SparkSession, database: str, name: str, counts: Counts, kind: str = "TABLE") -> None:
    shown = json.dumps(counts).replace("'", "''")
    spark.sql(f"ALTER {kind} {database}.`{name}` SET TBLPROPERTIES ('{COUNTS}' = '{shown}')")


def counts_of(spark: SparkSession, database: str, name: str) -> Counts | None:
    """What was counted while the table was written, None for a table saved without."""
    found = spark.sql(f"SHOW TBLPROPERTIES {database}.`{name}`").where(F.col("key") == COUNTS).first()
    return json.loads(found.value) if found else None


def save_table(df: DataFrame, database: str, name: str, declared: Table | None = None) -> DataFrame:
    """Create or replace a table with the rows of a query; with `declared`, count what it declares on the way."""
    spark = df.sparkSession
    folder = _new_folder(spark, database, name)
    seen = Observation()
    try:
        (df.observe(seen, *write_counts(declared)) if declared else df).write.parquet(folder)
    except Exception:
        _delete(spark, folder)
        raise
    saved = _point(spark, database, name, df.schema, folder)
    if declared:
        _keep_counts(spark, database, name, seen.get)
    _drop_others(spark, database, name, folder)
    return saved


def save_numbered(df: DataFrame, database: str, name: str, key: str, declared: Table | None = None) -> DataFrame:
    """Create or replace a table with the rows of a query, numbered 1..n in the order of its partitions as column `key`.

    The rows are written once. `name` is a view of the files written: a row's number is its place in its file plus the rows
    in the files before, which stand in a small table beside. Replacing the view switches both at once.
    """
    spark = df.sparkSession
    folder, places = _new_folder(spark, database, name), _new_folder(spark, database, f"{name}_files")
    seen = Observation()
    checked = Table(name, tuple(c for c in declared.columns if c.name != key)) if declared else None
    try:
        counted = df.observe(seen, *write_counts(checked)) if checked else df
        counted.write.options(**ONE_FILE).parquet(folder)
        stored = spark.read.schema(df.schema).parquet(folder)
        starts = list(enumerate(rows_before(stored)))
        spark.createDataFrame(starts, "part int, before long").coalesce(1).write.parquet(places)
    except Exception:
        for written in (folder, places):
            _delete(spark, written)
        raise
    columns = ", ".join(f"r.`{c.replace('`', '``')}`" for c in df.columns)
    part = r"cast(regexp_extract(r._metadata.file_name, '^part-([0-9]+)', 1) as int)"
    found = spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}")
    if found and found.tableType != "VIEW":
        spark.sql(f"DROP TABLE {database}.`{name}`")
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.`{name}` AS"
        f" SELECT /*+ BROADCAST(f) */ f.before + r._metadata.row_index + 1 AS `{key}`, {columns}"
        f" FROM parquet.`{folder}` r JOIN parquet.`{places}` f ON {part} = f.part"
    )
    if declared:  # the key is there for every row, by the way it is made
        _keep_counts(spark, database, name, {f"null {key}": 0, f"large {key}": 0} | seen.get, "VIEW")
    for written in (folder, places):
        _drop_others(spark, database, name, written)
    return spark.table(f"{database}.{name}")


def append_rows(df: DataFrame, database: str, name: str) -> None:
    """Insert the rows of a query into an existing table, matching columns by name."""
    target = f"{database}.{name}"
    df.select(*df.sparkSession.table(target).columns).write.insertInto(target)


def _write_parsed(
    spark: SparkSession,
    name: str,
    path: str,
    folder: str,
    pattern: str | None = None,
    buckets: Buckets | None = None,
    database: str = STAGING_DATABASE,
    **tokens,
) -> tuple[StructType, StructType, Counts]:
    """Parse the files and write them once, good rows to `bad=false` and bad ones to `bad=true`; the schemas of both and what
    the good ones count.

    Pieces of records that lie in several splits, a row per split at most, wait aside and are put together afterwards.
    """
    header = header_of(spark, path, pattern)
    starts = split_starts(spark, path, pattern, header)

    counts: Counts = {}
    writing = f"{database}.`{name}__{uuid.uuid4().hex}`"  # only a table can be written in buckets

    def write(records: DataFrame, kind) -> DataFrame:
        prepared, seen = prepare(parse(records, header), STAGING[name], **tokens), Observation()
        rows = prepared.withColumn("bad", kind).withColumnsRenamed(REJECT_COLUMNS).drop("_whole")
        rows = rows.repartition(buckets.number, buckets.key) if buckets else rows
        rows = rows.observe(seen, *write_counts(STAGING[name], F.col("bad") == "false"))
        writer = rows.write.mode("append").partitionBy("bad")
        if buckets:
            in_buckets = writer.format("parquet").bucketBy(buckets.number, buckets.key).sortBy(buckets.key)
            in_buckets.option("path", folder).saveAsTable(writing)
        else:
            writer.parquet(folder)
        for found, n in seen.get.items():
            counts[found] = counts.get(found, 0) + n
        return prepared

    is_bad = (F.size("_reasons") > 0).cast("string")
    prepared = write(
        read_pieces(spark, path, pattern, starts), F.when(F.col("_whole"), is_bad).otherwise(F.lit("part"))
    )
    parts, files = _path(spark, f"{folder}/bad=part")
    if files.exists(parts):
        waiting = spark.read.schema("file string, number long, _place long, record string").parquet(f"{folder}/bad=part")
        pieces = waiting.withColumnsRenamed({"_place": "place", "record": "text"}).withColumn("whole", F.lit(False))
        write(put_together(pieces), is_bad)
        files.delete(parts, True)
    if buckets:
        spark.sql(f"DROP TABLE {writing}")  # its files stay
    return accepted(prepared).schema, rejected(prepared).schema, counts


def load_table(
    spark: SparkSession,
    name: str,
    path: str,
    on_reject: str = "fail",
    database: str = STAGING_DATABASE,
    buckets: int = 0,
    **reading,
) -> DataFrame:
    """Replace one raw table with the content of its CSV files.

    With `buckets`, tables that hold an order's rows are dealt by order_id into so many sorted files by one shuffle, so that
    the fact joins them without another. A bucket is read by one task: leave it at 0 where single orders hold a large share
    of all rows, whose joins are spread instead.

    The files are parsed and written once, good and bad rows apart. Rows that do not fit stop the load (`fail`), and
    the old table stays; or they become the table `<name>_rejected` (`quarantine`), which else does not exist.
    """
    if on_reject not in ("fail", "quarantine"):
        raise ValueError(f"not an option: {on_reject}")
    folder = _new_folder(spark, database, name)
    try:
        dealt = Buckets(BUCKET_KEYS[name], buckets) if buckets and name in BUCKET_KEYS else None
        good, bad, counts = _write_parsed(spark, name, path, folder, buckets=dealt, database=database, **reading)
        spoilt, files = _path(spark, f"{folder}/bad=true")
        if on_reject == "fail" and files.exists(spoilt):
            found = spark.read.schema(bad).parquet(f"{folder}/bad=true")
            row = found.orderBy("file", "number").first()
            raise LoadError(f"{name}: {'; '.join(row.reasons)}, in {row.file}, record {row.number}: {row.record}")
    except Exception:
        _delete(spark, folder)
        raise
    if on_reject == "quarantine":
        _point(spark, database, f"{name}_rejected", bad, f"{folder}/bad=true")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {database}.`{name}_rejected`")
    loaded = _point(spark, database, name, good, f"{folder}/bad=false", dealt)
    _keep_counts(spark, database, name, counts)
    _drop_others(spark, database, name, folder)
    return loaded


def load_all(
    spark: SparkSession,
    folder: str,
    on_reject: str = "fail",
    patterns: Mapping[str, str] = FILE_PATTERNS,
    buckets: int = 0,
    **tokens,
) -> dict[str, DataFrame]:
    """Load every table of the file map, one committed job each."""
    create_databases(spark)
    return {
        name: load_table(spark, name, folder, on_reject, pattern=pattern, buckets=buckets, **tokens)
        for name, pattern in patterns.items()
    }


def load_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_loaded"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def saved_tables(spark: SparkSession, database: str, names) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}
