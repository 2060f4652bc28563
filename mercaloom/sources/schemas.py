"""Declared tables: columns, types, required columns, text lengths and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ByteType,
    StringType,
    StructField,
    StructType,
)

TEXT = StringType()
INT = IntegerType()
LONG = LongType()
MONEY = DecimalType(10, 2)
WIDE_MONEY = DecimalType(12, 2)
COORDINATE = DecimalType(10, 7)


@dataclass(frozen=True)
class Column:
    name: str
    type: DataType
    required: bool = False
    max_length: int | None = None  # declared text length
    digits: int | None = None  # declared digits before the decimal point, if stored wider


def _text(name: str, max_length: int | None, required: bool = False) -> Column:
    return Column(name, TEXT, required, max_length)


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: str | None = None

    @property
    def schema(self) -> StructType:
        # Spark does not enforce required columns, so all are nullable and checked instead.
        return StructType([StructField(c.name, c.type) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def limited(self) -> list[Column]:
        return [c for c in self.columns if c.max_length or c.digits]


# Names, types, lengths and required columns of the raw tables.
STAGING = {
    t.name: t
    for t in (
        Table(
            "orders",
            (
                _text("order_id", 50, True),
                _text("customer_id", 50, True),
                _text("order_status", 20, True),
                _text("order_purchase_timestamp", 50),
                _text("order_approved_at", 50),
                _text("order_delivered_carrier_date", 50),
                _text("order_delivered_customer_date", 50),
                _text("order_estimated_delivery_date", 50),
            ),
        ),
        Table(
            "order_items",
            (
                _text("order_id", 50, True),
                Column("order_item_id", INT, True),
                _text("product_id", 50, True),
                _text("seller_id", 50, True),
                _text("shipping_limit_date", 50, True),
                Column("price", MONEY, True),
                Column("freight_value", MONEY, True),
            ),
        ),
        Table(
            "customers",
            (
                _text("customer_id", 50, True),
                _text("customer_unique_id", 50, True),
                _text("customer_zip_code_prefix", 10),
                _text("customer_city", 100),
                _text("customer_state", 2),
            ),
        ),
        Table(
            "products",
            (
                _text("product_id", 50, True),
                _text("product_category_name", 100),
                Column("product_name_length", INT),
                Column("product_description_length", INT),
                Column("product_photos_qty", INT),
                Column("product_weight_g", INT),
                Column("product_length_cm", INT),
                Column("product_height_cm", INT),
                Column("product_width_cm", INT),
            ),
        ),
        Table(
            "sellers",
            (
                _text("seller_id", 50, True),
                _text("seller_zip_code_prefix", 10),
                _text("seller_city", 100),
                _text("seller_state", 2),
            ),
        ),
        Table(
            "payments",
            (
                _text("order_id", 50, True),
                Column("payment_sequential", INT, True),
                _text("payment_type", 50),
                Column("payment_installments", INT),
                Column("payment_value", MONEY),
            ),
        ),
        Table(
            "reviews",
            (
                _text("review_id", 50, True),
                _text("order_id", 50, True),
                Column("review_score", INT),
                _text("review_comment_title", None),
                _text("review_comment_message", None),
                _text("review_creation_date", 50),
                _text("review_answer_timestamp", 50),
            ),
        ),
        Table(
            "category_translation",
            (
                _text("product_category_name", 100, True),
                _text("product_category_name_english", 100),
            ),
        ),
        Table(
            "geolocation",
            (
                _text("geolocation_zip_code_prefix", 10, True),
                Column("geolocation_lat", COORDINATE),
                Column("geolocation_lng", COORDINATE),
                _text("geolocation_city", 100),
                _text("geolocation_state", 2),
            ),
        ),
    )
}

# Names, types, lengths, required columns and keys of the star schema.
WAREHOUSE = {
    t.name: t
    for t in (
        Table(
            "dim_date",
            (Column("date_key", INT, True), Column("full_date", DateType())),
            "date_key",
        ),
        Table(
            "dim_customer",
            (
                Column("customer_sk", LONG, True),
                _text("customer_id", 50),
                _text("customer_unique_id", 50),
                _text("customer_zip_code_prefix", 10),
                _text("customer_city", 100),
                _text("customer_state", 2),
            ),
            "customer_sk",
        ),
        Table(
            "dim_seller",
            (
                Column("seller_sk", LONG, True),
                _text("seller_id", 50),
                _text("seller_zip_code_prefix", 10),
                _text("seller_city", 100),
                _text("seller_state", 2),
            ),
            "seller_sk",
        ),
        Table(
            "dim_product",
            (
                Column("product_sk", LONG, True),
                _text("product_id", 50),
                _text("category_pt", 100),
                _text("category_en", 100),
                Column("product_name_length", INT),
                Column("product_description_length", INT),
                Column("product_photos_qty", INT),
                Column("product_weight_g", INT),
                Column("product_length_cm", INT),
                Column("product_height_cm", INT),
                Column("product_width_cm", INT),
            ),
            "product_sk",
        ),
        Table(
            "fact_sales",
            (
                Column("sales_sk", LONG),
                _text("order_id", 32, True),
                Column("order_item_id", INT, True),
                Column("customer_sk", LONG, True),
                Column("seller_sk", LONG, True),
                Column("product_sk", LONG, True),
                Column("purchase_date_key", INT, True),
                Column("delivered_date_key", INT),
                Column("estimated_date_key", INT, True),
                Column("price", WIDE_MONEY, True),
                Column("freight_value", WIDE_MONEY, True),
                Column("line_total", DecimalType(13, 2)),
                _text("payment_type", 20),
                Column("payment_installments", INT),
                # Declared with 10 digits before the point; stored wider, so that the total of an
                # order with very many payments is reported by the range check and not an error.
                Column("payment_value", DecimalType(20, 2), digits=10),
                Column("review_score", ByteType()),
                _text("order_status", 20),
                Column("is_delivered", INT),
                Column("is_canceled", INT),
                Column("is_late", INT),
                Column("days_to_deliver", INT),
                Column("days_late", INT),
            ),
            "sales_sk",
        ),
    )
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str


# The references the fact table declares.
FOREIGN_KEYS = (
    ForeignKey("fact_sales", "customer_sk", "dim_customer", "customer_sk"),
    ForeignKey("fact_sales", "seller_sk", "dim_seller", "seller_sk"),
    ForeignKey("fact_sales", "product_sk", "dim_product", "product_sk"),
    ForeignKey("fact_sales", "purchase_date_key", "dim_date", "date_key"),
)
