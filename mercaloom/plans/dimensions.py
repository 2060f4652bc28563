"""The four dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.keys import ordered_row_number
from ..operators.skew import MIN_HOT_ROWS, Lookup, look_up

# First and last day of the calendar, both included.
CALENDAR_START = datetime.date(2016, 1, 1)
CALENDAR_END = datetime.date(2021, 1, 1)


def build_dim_date(
    spark: SparkSession,
    start: datetime.date = CALENDAR_START,
    end: datetime.date = CALENDAR_END,
) -> DataFrame:
    """One row per day from `start` to `end`."""
    ends = spark.range(0, 1, 1, 1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return calendar_between(ends, "first", "last")


def calendar_between(ends: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between the two dates of the one row of `ends`, both included."""
    days = ends.select(F.explode(F.sequence(first, last)).alias("full_date"))
    return days.select(X.date_key(F.col("full_date")).alias("date_key"), "full_date")


def order_calendar(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last purchase: the moment of its first purchase and whether an order of the
    day was canceled; both null on days without orders."""
    bought = orders.select(
        X.parse_timestamp(F.col("order_purchase_timestamp")).alias("bought"),
        F.col("order_status").isin(*X.CANCELED_STATES).alias("canceled"),
    ).where("bought is not null")
    by_day = bought.groupBy(F.to_date("bought").alias("day")).agg(
        F.min("bought").alias("first_purchase"), F.bool_or("canceled").alias("any_canceled")
    )
    ends = by_day.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null")
    # one row per day on both sides
    return calendar_between(ends, "first", "last").join(by_day, F.col("full_date") == F.col("day"), "left").drop("day")


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer_id, numbered by person and then customer_id."""
    rows = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        X.clean_place(F.col("customer_city")).alias("customer_city"),
        "customer_state",
    )
    return ordered_row_number(rows, "customer_sk", "customer_unique_id", "customer_id")


def build_dim_seller(sellers: DataFrame) -> DataFrame:
    rows = sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        X.clean_place(F.col("seller_city")).alias("seller_city"),
        "seller_state",
    )
    return ordered_row_number(rows, "seller_sk", "seller_id")


def build_dim_product(
    products: DataFrame, translation: DataFrame, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Products with their category in both languages, 'Unknown' where there is none."""
    category = "product_category_name"
    words = Lookup(category, translation, "left")
    rows = look_up(products, words, min_rows=min_hot_rows).select(
        "product_id",
        X.or_unknown(F.col(category)).alias("category_pt"),
        X.or_unknown(F.col("product_category_name_english")).alias("category_en"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    return ordered_row_number(rows, "product_sk", "product_id")
