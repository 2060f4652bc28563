"""The sales fact: one row per order item."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.keys import ranges_by, row_identity
from ..operators.skew import MIN_HOT_ROWS, Lookup, look_up

# A first payment as one number: sequence, place of the type (0: none), installments (0: none), each in this many bits.
MOST_KINDS, LARGEST = 1000, 1 << 19
KIND_BITS, COUNT_BITS = 10, 21


def _payment_kinds(payments: DataFrame) -> list[str] | None:
    """The payment types in order, if there are few and the first payment fits into 64 bits."""
    bounds = [f(c) for c in ("payment_sequential", "payment_installments") for f in (F.min, F.max)]
    unknown = F.count_if(F.col("payment_sequential").isNull()).alias("unknown")
    by_type = payments.groupBy("payment_type").agg(unknown, *(b.alias(f"b{i}") for i, b in enumerate(bounds)))
    found = by_type.limit(MOST_KINDS + 2).collect()
    kinds = sorted((r.payment_type for r in found if r.payment_type is not None), key=str.encode)
    numbers = [v for r in found for v in list(r)[2:] if v is not None]
    fits = len(kinds) <= MOST_KINDS and all(-LARGEST <= v < LARGEST for v in numbers)
    return kinds if fits and not any(r.unknown for r in found) else None


def payment_per_order(payments: DataFrame) -> DataFrame:
    """Type and installments of the first payment, and the total, of every order.

    The first payment is the smallest (sequence, type, installments), missing values first, so one without a type stays
    without. Few types and small numbers, which one narrow pass finds, are packed into one number, whose minimum a
    hash table can hold; else the minimum is that of a struct.
    """
    kinds = _payment_kinds(payments)
    total = F.sum("payment_value").alias("payment_value")
    if kinds is None:
        first = F.min(F.struct("payment_sequential", "payment_type", "payment_installments"))
        found = payments.groupBy("order_id").agg(first.alias("first"), total)
        kind, installments = F.col("first.payment_type"), F.col("first.payment_installments")
    else:
        names = F.array(*map(F.lit, kinds)) if kinds else F.array(F.lit(None).cast("string"))
        place = F.coalesce(F.array_position(names, F.col("payment_type")), F.lit(0))
        count = F.coalesce(F.col("payment_installments").cast("long") + LARGEST + 1, F.lit(0))
        packed = (F.col("payment_sequential").cast("long") * (1 << KIND_BITS) + place) * (1 << COUNT_BITS) + count
        found = payments.groupBy("order_id").agg(F.min(packed).alias("first"), total)
        count = F.col("first").bitwiseAND((1 << COUNT_BITS) - 1)
        place = F.shiftright("first", COUNT_BITS).bitwiseAND((1 << KIND_BITS) - 1)
        kind = F.when(place > 0, F.element_at(names, F.greatest(place, F.lit(1)).cast("int")))
        installments = F.when(count > 0, count - LARGEST - 1).cast(payments.schema["payment_installments"].dataType)
    return found.select(
        "order_id",
        kind.alias("payment_type"),
        installments.alias("payment_installments"),
        F.col("payment_value").cast("decimal(20,2)").alias("payment_value"),
    )


def review_per_order(reviews: DataFrame) -> DataFrame:
    """Mean score of every order, to one decimal."""
    mean = F.avg(F.col("review_score").cast("double"))
    return reviews.groupBy("order_id").agg(F.round(mean, 1).alias("avg_review_score"))


def order_measures(orders: DataFrame) -> DataFrame:
    """Dates, flags and day counts, worked out once per order and not once per line."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_delivered_customer_date",
        X.parse_timestamp(F.col("order_purchase_timestamp")).alias("purchased"),
        X.parse_timestamp(F.col("order_delivered_customer_date")).alias("delivered"),
        X.parse_timestamp(F.col("order_estimated_delivery_date")).alias("estimated"),
    ).select(
        "order_id",
        "customer_id",
        X.date_key(F.col("purchased")).alias("purchase_date_key"),
        X.date_key(F.col("delivered")).alias("delivered_date_key"),
        X.date_key(F.col("estimated")).alias("estimated_date_key"),
        "order_status",
        X.flag(F.col("order_delivered_customer_date").isNotNull()).alias("is_delivered"),
        X.flag(F.col("order_status").isin(*X.CANCELED_STATES)).alias("is_canceled"),
        X.flag(F.col("delivered") > F.col("estimated")).alias("is_late"),
        X.day_count(F.col("purchased"), F.col("delivered")).alias("days_to_deliver"),
        X.day_count(F.col("estimated"), F.col("delivered")).alias("days_late"),
    )


def sales_lines(
    staging: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The fact without its own key.

    Everything known per order is joined first, on rows that are one per order; the lines then look
    up product, seller and order. Payments, reviews, orders and lines share the shuffle on order_id.
    """
    per_order = look_up(
        order_measures(staging["orders"]),
        Lookup("customer_id", dims["dim_customer"].select("customer_id", "customer_sk")),
        Lookup("order_id", payment_per_order(staging["payments"]), "left", measurable=False),
        Lookup("order_id", review_per_order(staging["reviews"]), "left", measurable=False),
        min_rows=min_hot_rows,
    )
    lines = look_up(
        staging["order_items"].select(
            "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
        ),
        Lookup("product_id", dims["dim_product"].select("product_id", "product_sk")),
        Lookup("seller_id", dims["dim_seller"].select("seller_id", "seller_sk")),
        Lookup("order_id", per_order, measurable=False),
        min_rows=min_hot_rows,
    )
    price = F.col("price").cast("decimal(12,2)")
    freight = F.col("freight_value").cast("decimal(12,2)")
    return lines.select(
        "order_id",
        "order_item_id",
        "customer_sk",
        "seller_sk",
        "product_sk",
        "purchase_date_key",
        "delivered_date_key",
        "estimated_date_key",
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("line_total"),
        "payment_type",
        "payment_installments",
        "payment_value",
        # Cut off, not rounded; 0 stands for an order without a review.
        F.coalesce("avg_review_score", F.lit(0.0)).cast("tinyint").alias("review_score"),
        "order_status",
        "is_delivered",
        "is_canceled",
        "is_late",
        "days_to_deliver",
        "days_late",
    )


MONTH = "purchase_month"


def with_month(lines: DataFrame) -> DataFrame:
    """The fact's rows with the month of purchase as yyyyMM, null without a readable date."""
    return lines.withColumn(MONTH, F.floor(F.col("purchase_date_key") / 100).cast("int"))


def lines_of_months(
    staging: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    months: Collection[int],
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The fact's rows of some months of purchase: the orders of other months go before any join."""
    bought = X.date_key(X.parse_timestamp(F.col("order_purchase_timestamp")))
    orders = staging["orders"].where(F.floor(bought / 100).cast("int").isin(*months))
    return with_month(sales_lines({**staging, "orders": orders}, dims, min_hot_rows))


def build_fact_sales(
    staging: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    ordered: bool = False,
    min_hot_rows: int = MIN_HOT_ROWS,
    number: Callable[[DataFrame, str], DataFrame] = row_identity,
) -> DataFrame:
    """The complete fact, written once by `number`, which gives the rows their key from the files written.

    The key may be any numbering without repeats. By default the rows are numbered where they are;
    `ordered` numbers by order and line, the same on every run, and costs a range shuffle, whose bounds come from the raw
    lines.
    """
    lines = sales_lines(staging, dims, min_hot_rows)
    if ordered:
        lines = ranges_by(staging["order_items"], lines, "order_id", "order_item_id", min_rows=min_hot_rows)
    return number(lines, "sales_sk")
