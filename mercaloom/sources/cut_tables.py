"""Saved tables cut into folders by a column, so that readers of some values list their files only and single values can be
replaced.

A table is a view of one or more contents. The first holds all values; a refresh writes the rows of some values to a content
of its own, and the new view leaves these values out of the earlier ones. The values are folders, so both the reader's
filter and the view's are answered by listing. Replacing the view switches everything at once. Rows are numbered from the
files written, as in `save_numbered`; refreshed rows get numbers after all earlier ones, so that no other row's changes.
"""

from __future__ import annotations

import json
from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.integrity import write_counts
from ..operators.keys import file_part
from ..operators.storage import ONE_FILE
from . import tables as T
from .schemas import Table

CONTENTS = "mercaloom.contents"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def contents_of(spark: SparkSession, database: str, name: str) -> list[dict]:
    """The contents of a cut table, oldest first; none if there is no such table."""
    if not spark.catalog.tableExists(f"{database}.{name}"):
        return []
    found = spark.sql(f"SHOW TBLPROPERTIES {database}.{_quoted(name)}").where(F.col("key") == CONTENTS).first()
    return json.loads(found.value) if found else []


def _write(df: DataFrame, database: str, name: str, by: str, start: int, table: Table | None) -> tuple[dict, dict]:
    """Writes the rows as a new content numbered from `start`: its description, and what `table` declares as counted."""
    spark = df.sparkSession
    folder, places = T._new_folder(spark, database, name), T._new_folder(spark, database, f"{name}_files")
    seen = Observation()
    try:
        counted = df.observe(seen, *write_counts(table), F.count("*").alias("all")) if table else df.observe(seen, F.count("*").alias("all"))
        counted.write.options(**ONE_FILE).partitionBy(by).parquet(folder)
        counts = dict(seen.get)
        total = counts.pop("all")
        if total:
            # one row per file; those of a task are in the order of their values, as its rows are
            stored = spark.read.schema(df.schema).parquet(folder)
            sizes = stored.groupBy(F.col(by).alias("value"), file_part().alias("part")).agg(F.count("*").alias("n"))
            ahead = Window.orderBy("part", "value").rowsBetween(Window.unboundedPreceding, -1)
            before = F.coalesce(F.sum("n").over(ahead), F.lit(0)) + start
            sizes.select("part", "value", before.alias("before")).coalesce(1).write.parquet(places)
    except Exception:
        for written in (folder, places):
            T._delete(spark, written)
        raise
    return {"folder": folder, "places": places, "rows": total, "values": None, "end": start + total}, counts


def _without(by: str, values: set) -> str:
    """A condition on a column that leaves some values out, null among them or not."""
    kept = f"r.{by} IS NOT NULL" if None in values else f"r.{by} IS NULL"
    listed = ", ".join(str(v) for v in sorted(v for v in values if v is not None))
    if not listed:
        return kept if None in values else "true"
    return f"({kept} AND r.{by} NOT IN ({listed}))" if None in values else f"({kept} OR r.{by} NOT IN ({listed}))"


def _show(spark: SparkSession, database: str, name: str, key: str, by: str, schema, contents: list[dict]) -> DataFrame:
    """Point the view at the contents, drop those that it no longer names."""
    part = r"cast(regexp_extract(r._metadata.file_name, '^part-([0-9]+)', 1) as int)"
    columns = ", ".join(f"r.{_quoted(f.name)}" for f in schema)
    empty = ", ".join(f"cast(null as {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in schema)
    branches, replaced = [], set()
    for content in reversed(contents):
        if content["rows"]:
            branches.append(
                f"SELECT /*+ BROADCAST(f) */ f.before + r._metadata.row_index + 1 AS {_quoted(key)}, {columns}"
                f" FROM parquet.`{content['folder']}` r JOIN parquet.`{content['places']}` f"
                f" ON {part} = f.part AND r.{_quoted(by)} <=> f.value WHERE {_without(_quoted(by), replaced)}"
            )
        replaced |= set(content["values"] or ())
    branches = branches or [f"SELECT cast(null as bigint) AS {_quoted(key)}, {empty} WHERE false"]
    found = spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}")
    if found and found.tableType != "VIEW":
        spark.sql(f"DROP TABLE {database}.{_quoted(name)}")
    described = json.dumps(contents).replace("'", "''")
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{_quoted(name)} TBLPROPERTIES ('{CONTENTS}' = '{described}') AS"
        f" {' UNION ALL '.join(branches)}"
    )
    for written in (contents[-1]["folder"], contents[-1]["places"]):
        path, files = T._path(spark, written)
        files.mkdirs(path)  # no rows, no folder
        T._drop_others(spark, database, name, written)
    return spark.table(f"{database}.{name}")


def save_cut(df: DataFrame, database: str, name: str, key: str, by: str, declared: Table | None = None) -> DataFrame:
    """Create or replace a table with the rows of a query, cut by `by` and numbered 1..n as `key`.

    The rows should come in the order of `by`, so that a task writes few files.
    """
    table = Table(name, tuple(c for c in declared.columns if c.name != key)) if declared else None
    content, counts = _write(df, database, name, by, 0, table)
    saved = _show(df.sparkSession, database, name, key, by, df.schema, [content])
    if declared:
        T._keep_counts(df.sparkSession, database, name, {f"null {key}": 0, f"large {key}": 0} | counts, "VIEW")
    return saved


def refresh_cut(df: DataFrame, database: str, name: str, key: str, by: str, values: Collection[int | None]) -> DataFrame:
    """Replace the rows of some values of `by` by those of a query, which may hold no others. All other rows stay, with
    their numbers. What was counted when the table was written is no longer known."""
    spark = df.sparkSession
    contents = contents_of(spark, database, name)
    if not contents:
        raise ValueError(f"not a cut table: {database}.{name}")
    values = set(values)
    listed = F.col(by).isin(*(values - {None})) if values - {None} else F.lit(False)
    allowed = F.when(F.col(by).isNull(), F.lit(None in values)).otherwise(listed)
    other = F.raise_error(F.concat(F.lit(f"{by} not among those to refresh: "), F.coalesce(F.col(by).cast("string"), F.lit("null"))))
    checked = df.where(F.when(allowed, F.lit(True)).otherwise(other.cast("boolean")))
    content, _ = _write(checked, database, name, by, contents[-1]["end"], None)
    content["values"] = sorted(values, key=lambda v: (v is not None, v))
    # a content all of whose values have been replaced since is dropped
    later = set(content["values"])
    kept = [c for c in contents if c["values"] is None or not set(c["values"]) <= later]
    return _show(spark, database, name, key, by, df.schema, [*kept, content])
