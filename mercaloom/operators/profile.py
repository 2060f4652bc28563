"""Column profile: one row of statistics per column."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..functions import expressions as X

# Parts of a column name that mark text as dates.
DATE_NAME_PARTS = ("date", "timestamp")

MOMENT, DATE_TEXT, TEXT, EXACT, FLOATING, OTHER = (
    "moment",
    "date text",
    "text",
    "exact number",
    "floating number",
    "other",
)

PROFILE_COLUMNS = (
    "table_name",
    "column_name",
    "total_rows",
    "distinct_cnt",
    "null_cnt",
    "min_val",
    "max_val",
    "avg_val",
    "avg_length",
    "negative_cnt",
    "invalid_date",
)


def column_kind(name: str, dtype: DataType, date_columns: Collection[str] = ()) -> str:
    """What to report about a column, from its type and, for text, its name."""
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return MOMENT
    if isinstance(dtype, StringType):
        named_date = any(part in name.lower() for part in DATE_NAME_PARTS)
        return DATE_TEXT if named_date or name in date_columns else TEXT
    if isinstance(dtype, (DoubleType, FloatType)):
        return FLOATING
    return EXACT if isinstance(dtype, NumericType) else OTHER


def _as_text(column: Column, dtype: DataType) -> Column:
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, (NumericType, StringType, DateType)):
        return column.cast("string")
    return F.to_json(F.struct(column))


def _exact_type(df: DataFrame) -> str:
    """One decimal type that holds every exact number of the table."""
    types = [f.dataType for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    scale = max((t.scale for t in types), default=0)
    return f"decimal(38,{scale})"


def profile(
    df: DataFrame, table_name: str, date_columns: Collection[str] = ()
) -> DataFrame:
    """Statistics of all columns in one scan and one large shuffle.

    The table is turned into (column number, value) pairs, which are counted; counts are combined
    before the shuffle, so a frequent value costs no more than a rare one. Every statistic follows
    from the distinct values and their counts; dates are parsed once per distinct value.

    Two aggregates read the counted values, which are shuffled once: sums and numeric extremes by column number, in hash
    tables of fixed-width buffers, and the extremes of texts, one row for all columns. Nothing is sorted.
    """
    fields = df.schema.fields
    kinds = [column_kind(f.name, f.dataType, date_columns) for f in fields]
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("c"),
                F.when(
                    X.column(f.name).isNotNull(), _as_text(X.column(f.name), f.dataType)
                ).alias("value"),
            )
            for i, f in enumerate(fields)
        ]
    )
    counted = df.select(F.inline(pairs)).groupBy("c", "value").agg(F.count(F.lit(1)).alias("n"))

    def of_kind(*wanted: str) -> Column:
        numbers = [i for i, kind in enumerate(kinds) if kind in wanted]
        return F.col("c").isin(*numbers) if numbers else F.lit(False)

    value, n = F.col("value"), F.col("n")
    exact, floating = of_kind(EXACT), of_kind(FLOATING)
    text, numeric = of_kind(DATE_TEXT, TEXT), of_kind(EXACT, FLOATING)
    present = value.isNotNull()

    typed = counted.select(
        "c",
        "n",
        present.alias("present"),
        F.when(exact, value.try_cast(_exact_type(df))).alias("as_exact"),
        F.when(numeric, value.try_cast("double")).alias("as_double"),
        F.when(floating, value.try_cast("double")).alias("as_floating"),
        F.when(text & present, X.text_length(value) * n).alias("length_sum"),
        F.when(of_kind(DATE_TEXT), X.is_invalid_date(value)).alias("invalid"),
    )
    stats = typed.groupBy("c").agg(
        F.sum("n").alias("total_rows"),
        F.count_if("present").alias("distinct_cnt"),
        F.sum(F.when(~F.col("present"), n).otherwise(0)).alias("null_cnt"),
        *[
            of(column).alias(f"{which}_{kind}")
            for kind, column in (("exact", "as_exact"), ("floating", "as_floating"))
            for which, of in (("min", F.min), ("max", F.max))
        ],
        F.sum(F.col("as_double") * n).alias("value_sum"),
        F.sum(F.when(F.col("present"), n).otherwise(0)).alias("present_cnt"),
        F.sum("length_sum").alias("length_sum"),
        F.sum(F.when(F.col("as_double") < 0, n).otherwise(0)).alias("negative"),
        F.sum(F.when(F.col("invalid"), n).otherwise(0)).alias("invalid"),
    )
    ordered = [i for i, kind in enumerate(kinds) if kind in (MOMENT, DATE_TEXT)]
    texts = [F.when(F.col("c") == i, value) for i in ordered]
    ends = [F.struct(F.lit(i).alias("text_c"), F.min(t).alias("min_text"), F.max(t).alias("max_text")) for i, t in zip(ordered, texts)]
    # The largest count is not used: it keeps this aggregate's shuffle the same as the other's, so it is made once.
    extremes = counted.agg(F.max("n").alias("n"), *(end.alias(f"e{i}") for i, end in zip(ordered, ends)))
    if ordered:
        extremes = extremes.where("n is not null").select(F.inline(F.array(*(f"e{i}" for i in ordered))))
    # A table without rows still has a line per column.
    names = F.posexplode(F.array(*[F.lit(f.name) for f in fields])).alias("c", "column_name")
    every_column = df.sparkSession.range(0, 1, 1, 1).select(names)

    def whole(column: str) -> Column:
        return F.coalesce(column, F.lit(0).cast("long"))

    def typed_text(which: str) -> Column:
        """A numeric extreme as its own column's type writes it."""
        shown = F.lit(None).cast("string")
        for i, (f, kind) in enumerate(zip(fields, kinds)):
            if kind in (EXACT, FLOATING):
                number = F.col(f"{which}_{'exact' if kind == EXACT else 'floating'}")
                shown = F.when(F.col("c") == i, _as_text(number.cast(f.dataType), f.dataType)).otherwise(shown)
        return shown

    def extreme(which: str) -> Column:
        shown = F.coalesce(f"{which}_text", typed_text(which)) if ordered else typed_text(which)
        moment_layout = F.substring(shown, 1, 19)
        return F.when(of_kind(MOMENT), moment_layout).otherwise(shown)

    # All sides have one row per column.
    known = every_column.join(F.broadcast(stats), "c", "left")
    if ordered:
        known = known.join(F.broadcast(extremes), F.col("c") == F.col("text_c"), "left")
    return known.select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        whole("total_rows").alias("total_rows"),
        whole("distinct_cnt").alias("distinct_cnt"),
        "null_cnt",
        extreme("min").alias("min_val"),
        extreme("max").alias("max_val"),
        F.when(numeric, X.ratio(F.col("value_sum"), F.col("present_cnt"))).alias("avg_val"),
        F.when(text, F.expr("length_sum div nullif(present_cnt, 0)"))
        .cast("double")
        .alias("avg_length"),
        F.when(numeric, F.col("negative")).alias("negative_cnt"),
        F.when(of_kind(DATE_TEXT), F.col("invalid")).alias("invalid_date"),
    )


def profile_approximate(
    df: DataFrame, table_name: str, date_columns: Collection[str] = (), error: float = 0.02
) -> DataFrame:
    """The profile with estimated distinct counts: a single aggregate row and no large shuffle."""
    aggregates = []
    for i, f in enumerate(df.schema.fields):
        kind = column_kind(f.name, f.dataType, date_columns)
        column = X.column(f.name)
        moment_or_text = kind in (MOMENT, DATE_TEXT)
        numeric = kind in (EXACT, FLOATING)
        shown = moment_or_text or numeric
        is_text = kind in (DATE_TEXT, TEXT)
        lowest, highest = F.min(column), F.max(column)
        if kind == MOMENT and not isinstance(f.dataType, DateType):
            lowest, highest = (F.date_format(m, "yyyy-MM-dd HH:mm:ss") for m in (lowest, highest))
        lengths = F.sum(X.text_length(column))
        none = F.lit(None)
        aggregates.append(
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.count(F.lit(1)).alias("total_rows"),
                F.approx_count_distinct(column, error).alias("distinct_cnt"),
                F.sum(F.when(column.isNull(), 1).otherwise(0)).alias("null_cnt"),
                (lowest if shown else none).cast("string").alias("min_val"),
                (highest if shown else none).cast("string").alias("max_val"),
                (F.avg(column.cast("double")) if numeric else none).cast("double").alias("avg_val"),
                (F.floor(lengths / F.nullif(F.count(column), F.lit(0))) if is_text else none)
                .cast("double")
                .alias("avg_length"),
                (F.count_if(column < 0) if numeric else none).cast("long").alias("negative_cnt"),
                (F.count_if(X.is_invalid_date(column)) if kind == DATE_TEXT else none)
                .cast("long")
                .alias("invalid_date"),
            ).alias(f"c{i}")
        )
    row = df.agg(*aggregates)
    return row.select(F.inline(F.array(*row.columns)))


def profile_all(
    tables: dict[str, DataFrame], date_columns: Collection[str] = ()
) -> DataFrame:
    parts = [profile(df, name, date_columns) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def render_profile(profiled: DataFrame) -> DataFrame:
    """The profile as a report: sorted by column, '-' where a statistic does not apply."""
    shown = {"avg_val", "avg_length", "negative_cnt", "invalid_date"}
    return profiled.select(
        *[X.display(F.col(c)).alias(c) if c in shown else F.col(c) for c in PROFILE_COLUMNS]
    ).orderBy("table_name", "column_name")
