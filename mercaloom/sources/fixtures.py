"""Adapter from the generic test tables to the nine raw retail tables.

The test tables have no NULL and no broken reference; the adapter plants missing values, orphans, dates in many forms
and ties, so that every check has something to find. It plants by writing other values and drops no row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import grouped_row_number
from ..operators.skew import MIN_HOT_ROWS, Lookup, find_hot_keys, look_up

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in SOURCE_TABLES}


def _order_base(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey as k",
        "o_totalprice as total",
        """case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else
           case o_orderkey % 3 when 0 then 'canceled' when 1 then 'unavailable' else 'delivered' end
           end as status""",
        """o_orderdate + (o_orderkey % 24) * interval '1' hour
           + (o_orderkey % 60) * interval '1' minute as purchased""",
        "o_orderdate as day",
    )


def _orders(base: DataFrame) -> DataFrame:
    # some orders have an id that nothing refers to and the customer of another order
    delivered = "day + (3 + k % 25) * interval '1' day + (k % 24) * interval '1' hour"
    return base.selectExpr(
        "if(k % 101 = 0, 'x', 'o') || cast(k as string) as order_id",
        "'c' || cast(k + if(k % 101 = 0, 1, 0) as string) as customer_id",
        "status as order_status",
        "cast(purchased as string) as order_purchase_timestamp",
        "case when k % 29 <> 0 then cast(purchased + interval '1' hour as string) end"
        " as order_approved_at",
        """case when status in ('delivered', 'shipped')
           then cast(purchased + interval '2' day as string) end
           as order_delivered_carrier_date""",
        f"""case when k % 211 = 0 then 'not a date'
            when k % 211 = 1 then '2017-1-2 10:56:33.1' when k % 211 = 2 then '2017/10/02'
            when (status = 'delivered' and k % 37 <> 0) or (status = 'canceled' and k % 5 = 0)
            then case k % 13
                when 1 then cast({delivered} as string) || '.125'
                when 2 then substr(cast({delivered} as string), 1, 16)
                when 3 then replace(cast({delivered} as string), ' ', 'T')
                when 4 then replace(substr(cast({delivered} as string), 1, 10), '-', '')
                when 5 then cast({delivered} as string) || '  '
                when 6 then ' ' || substr(cast({delivered} as string), 1, 10)
                else cast({delivered} as string) end
            end as order_delivered_customer_date""",
        "cast(day + (18 + k % 11) * interval '1' day as string) as order_estimated_delivery_date",
    )


def _places(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey", "lower(n_name) as city", "substr(r_name, 1, 2) as state"
    )


def _customers(orders: DataFrame, customer: DataFrame, places: DataFrame, min_rows: int):
    people = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey as o_custkey", "city", "state"
    )
    keys = orders.select("o_custkey", "o_orderkey")
    return look_up(keys, Lookup("o_custkey", people), min_rows=min_rows).selectExpr(
        "'c' || cast(o_orderkey as string) as customer_id",
        "'u' || cast(o_custkey as string) as customer_unique_id",
        "case when o_custkey % 83 <> 0 then cast(1000 + o_custkey * 53 % 90000 as string) end"
        " as customer_zip_code_prefix",
        "'  ' || city || ' ' as customer_city",
        "state as customer_state",
    )


def _sellers(supplier: DataFrame, places: DataFrame) -> DataFrame:
    return supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "'s' || cast(s_suppkey as string) as seller_id",
        "cast(1000 + s_suppkey as string) as seller_zip_code_prefix",
        "' ' || city as seller_city",
        "state as seller_state",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "'p' || cast(p_partkey as string) as product_id",
        "case when p_partkey % 61 <> 0 then lower(p_type) end as product_category_name",
        "length(p_name) as product_name_length",
        "p_size * 10 as product_description_length",
        "case when p_partkey % 53 <> 0 then cast(p_partkey % 9 as int) end as product_photos_qty",
        "p_size * 100 as product_weight_g",
        "p_size as product_length_cm",
        "p_size as product_height_cm",
        "p_size as product_width_cm",
    )


def _category_translation(part: DataFrame) -> DataFrame:
    # one category has no translation, and one translation no category
    return part.selectExpr(
        "if(p_type = 'ECONOMY', 'unused', lower(p_type)) as product_category_name",
        "'en_' || lower(p_type) as product_category_name_english",
    ).distinct()


def _order_items(lineitem: DataFrame, min_rows: int) -> DataFrame:
    # numbered under the id that the orders are joined by, so one shuffle and one sort serve both
    lines = lineitem.select(
        F.expr("'o' || cast(l_orderkey as string)").alias("order_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_shipdate",
    )
    hot = find_hot_keys(lines, "order_id", min_rows=min_rows)["order_id"]
    numbered = grouped_row_number(
        lines,
        "line",
        "order_id",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_shipdate",
        hot=hot,
    )
    return numbered.selectExpr(
        "order_id",
        "cast(line as int) as order_item_id",
        # some products and sellers leave their lines to the next one
        "'p' || cast(l_partkey + if(l_partkey % 97 = 0, 1, 0) as string) as product_id",
        "'s' || cast(l_suppkey + if(l_suppkey % 17 = 0, 1, 0) as string) as seller_id",
        "cast(l_shipdate as string) as shipping_limit_date",
        "cast(l_extendedprice as decimal(10, 2)) as price",
        "cast(l_quantity as decimal(10, 2)) as freight_value",
    )


def _payments(base: DataFrame) -> DataFrame:
    # some orders leave their payments to the next one, numbered behind its own
    return (
        base.selectExpr("k", "total", "explode(sequence(1, cast(1 + k % 3 as int))) as seq")
        .selectExpr(
            "'o' || cast(k + if(k % 50 = 0, 1, 0) as string) as order_id",
            "seq + if(k % 50 = 0, 10, 0) as payment_sequential",
            """case when (k + seq) % 11 = 0 then null else
               case (k + seq) % 4 when 0 then 'credit_card' when 1 then 'boleto'
               when 2 then 'voucher' else 'debit_card' end end as payment_type""",
            "cast(1 + (k * seq) % 10 as int) as payment_installments",
            "case when seq = 1 then cast(total as decimal(10, 2))"
            " else cast(seq as decimal(10, 2)) end as payment_value",
        )
    )


def _reviews(base: DataFrame) -> DataFrame:
    # some orders leave their reviews to the next one
    return (
        base.selectExpr("k", "day", "purchased", "explode(sequence(0, if(k % 40 = 1, 1, 0))) as n")
        .selectExpr(
            "'r' || cast(k as string) || '-' || cast(n as string) as review_id",
            "'o' || cast(k + if(k % 8 = 0, 1, 0) as string) as order_id",
            "cast(1 + (k + n * 3) % 5 as int) as review_score",
            "cast(null as string) as review_comment_title",
            "case when k % 3 = 0 then 'text ' || cast(k as string) end as review_comment_message",
            "cast(day + interval '30' day as string) as review_creation_date",
            "cast(purchased + interval '31' day as string) as review_answer_timestamp",
        )
    )


def _geolocation(customer: DataFrame, places: DataFrame) -> DataFrame:
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "cast(1000 + c_custkey * 53 % 90000 as string) as geolocation_zip_code_prefix",
        "cast(cast(-23000 - c_custkey % 1000 as decimal(12, 3)) * cast(0.001 as decimal(4, 3))"
        " as decimal(10, 7)) as geolocation_lat",
        "cast(-46 as decimal(10, 7)) as geolocation_lng",
        "city as geolocation_city",
        "state as geolocation_state",
    )


class StagingTables(Mapping):
    """The nine raw tables, each set up when it is first asked for.

    They are not stored: a query computes only the columns it uses.
    """

    def __init__(self, source: dict[str, DataFrame], min_hot_rows: int = MIN_HOT_ROWS):
        base = _order_base(source["orders"])
        places = _places(source["nation"], source["region"])
        self._recipes = {
            "orders": lambda: _orders(base),
            "order_items": lambda: _order_items(source["lineitem"], min_hot_rows),
            "customers": lambda: _customers(
                source["orders"], source["customer"], places, min_hot_rows
            ),
            "products": lambda: _products(source["part"]),
            "sellers": lambda: _sellers(source["supplier"], places),
            "payments": lambda: _payments(base),
            "reviews": lambda: _reviews(base),
            "category_translation": lambda: _category_translation(source["part"]),
            "geolocation": lambda: _geolocation(source["customer"], places),
        }
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._recipes[name]()
        return self._tables[name]

    def __iter__(self):
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)
