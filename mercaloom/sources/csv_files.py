"""Reading the raw CSV files: header, null tokens, types, rejected rows."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType

from .csv_records import read_records
from .schemas import STAGING, Table
from .schemas import Column as Declared

# The raw file of each table, with any prefix and any number of parts.
FILE_PATTERNS = {
    "customers": "*customers_dataset*.csv",
    "products": "*products_dataset*.csv",
    "sellers": "*sellers_dataset*.csv",
    "orders": "*orders_dataset*.csv",
    "order_items": "*order_items_dataset*.csv",
    "geolocation": "*geolocation_dataset*.csv",
    "payments": "*order_payments_dataset*.csv",
    "reviews": "*order_reviews_dataset*.csv",
    "category_translation": "*category_name_translation*.csv",
}

# Misspelt headers and the names of the declared columns.
HEADER_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

# Cell texts that mean "no value", the defaults of the pandas CSV reader.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

CORRUPT = "_corrupt_record"
RECORD_COLUMNS = ("_file", "_number", "_place", "_text", "_whole")
DIALECT = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def header_of(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    options = {"header": True, "escape": '"', **({"pathGlobFilter": pattern} if pattern else {})}
    return spark.read.options(**options).csv(path).columns


def parse(records: DataFrame, header: list[str]) -> DataFrame:
    """All columns as text under the header's names, with the text of malformed records kept aside.

    Adds `_file`, `_number` (from 1 in each file; the header is 0 and goes), `_place`, `_text` and `_whole` of the record.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*header, CORRUPT))
    rows = records.where("number > 0").withColumn("_cells", F.from_csv("text", schema, DIALECT))
    cells = [F.col("_cells").getField(c) for c in header]
    corrupt = F.col("_cells").getField(CORRUPT)
    return rows.select(
        *(c.alias(name) for c, name in zip(cells, header)),
        F.when(F.col("whole"), corrupt).otherwise(F.col("text")).alias(CORRUPT),
        F.col("file").alias("_file"),
        F.col("number").alias("_number"),
        F.col("place").alias("_place"),
        F.col("text").alias("_text"),
        F.col("whole").alias("_whole"),
    )


def _value(text: Column, declared: Declared) -> Column:
    if isinstance(declared.type, IntegerType):
        # A nullable whole number may be written with decimals, as in 40.0.
        number = text.try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), F.floor(number).try_cast("int"))
    if isinstance(declared.type, DecimalType):
        return text.try_cast(declared.type.simpleString())
    return text


def prepare(
    raw: DataFrame,
    table: Table,
    null_tokens: Collection[str] = NULL_TOKENS,
    column_tokens: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """The declared columns with their types, and why a row does not fit.

    Adds `_reasons`, empty for a good row, and for a bad one `_file`, `_number` and `_record`, its place and text.
    `column_tokens` replaces the null tokens of single columns, so that a title "NA" can be kept.
    """
    renamed = raw.withColumnsRenamed({k: v for k, v in HEADER_RENAMES.items() if k in raw.columns})
    found = set(renamed.columns) - {CORRUPT, *RECORD_COLUMNS}
    declared = {c.name for c in table.columns}
    if found != declared:
        raise ValueError(
            f"{table.name}: missing columns {sorted(declared - found)},"
            f" unknown columns {sorted(found - declared)}"
        )
    tokens = column_tokens or {}
    texts = renamed.select(
        *[
            F.when(~F.col(c.name).isin(*tokens.get(c.name, null_tokens)), F.col(c.name)).alias(
                c.name
            )
            for c in table.columns
        ],
        CORRUPT,
        *RECORD_COLUMNS,
    )
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed record"))]
    for c in table.columns:
        text = F.col(c.name)
        if c.required:
            reasons.append(F.when(text.isNull(), F.lit(f"{c.name}: missing")))
        if c.max_length:
            reasons.append(
                F.when(F.length(text) > c.max_length, F.lit(f"{c.name}: over {c.max_length} long"))
            )
        if not isinstance(c.type, StringType):
            reasons.append(
                F.when(
                    text.isNotNull() & _value(text, c).isNull(),
                    F.lit(f"{c.name}: not {c.type.simpleString()}"),
                )
            )
    why = F.array_compact(F.array(*reasons))
    is_bad = F.size(why) > 0
    return texts.select(
        *[_value(F.col(c.name), c).alias(c.name) for c in table.columns],
        *[
            F.when(is_bad, F.col(found)).alias(shown)
            for found, shown in (("_file", "_file"), ("_number", "_number"), ("_text", "_record"), ("_place", "_place"))
        ],
        "_whole",
        why.alias("_reasons"),
    )


REJECT_COLUMNS = {"_file": "file", "_number": "number", "_record": "record", "_reasons": "reasons"}


def accepted(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.size("_reasons") == 0).drop(*REJECT_COLUMNS, "_place", "_whole")


def rejected(prepared: DataFrame) -> DataFrame:
    bad = prepared.where(F.size("_reasons") > 0)
    return bad.select(*(F.col(c).alias(name) for c, name in REJECT_COLUMNS.items()))


def read_table(
    spark: SparkSession, name: str, path: str, pattern: str | None = None, **tokens
) -> DataFrame:
    """One raw table, typed, with the reasons for rejecting rows."""
    header = header_of(spark, path, pattern)
    return prepare(parse(read_records(spark, path, pattern, header), header), STAGING[name], **tokens)
