"""Hand-made rows for the rules that are easy to get wrong."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercaloom.functions import expressions as X
from mercaloom.operators import explore as E
from mercaloom.operators import integrity as I
from mercaloom.operators.profile import profile, profile_approximate, render_profile
from mercaloom.plans import fact
from mercaloom.plans.dimensions import build_dim_customer, build_dim_date, build_dim_product
from mercaloom.plans.pipeline import build_star
from mercaloom.sources.schemas import STAGING, WAREHOUSE
from tests.conftest import rows_of


def frame(spark, table, *rows):
    """Rows of a declared table given as dicts; other columns are NULL."""
    schema = STAGING[table].schema
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expression).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2017-10-02 10:56:33", datetime.datetime(2017, 10, 2, 10, 56, 33)),
        ("2017-10-02", datetime.datetime(2017, 10, 2)),
        ("2017-10-02 10:56:33.123", datetime.datetime(2017, 10, 2, 10, 56, 33, 123000)),
        ("2017-10-02 10:56:33.1234567", datetime.datetime(2017, 10, 2, 10, 56, 33, 123456)),
        ("2017-10-02 10:56", datetime.datetime(2017, 10, 2, 10, 56)),
        ("2017-10-02T10:56:33", datetime.datetime(2017, 10, 2, 10, 56, 33)),
        ("20171002", datetime.datetime(2017, 10, 2)),
        (" 2017-10-02 10:56:33 ", datetime.datetime(2017, 10, 2, 10, 56, 33)),
        ("2017-1-2 10:56:33.1", None),
        (" 2017-10-2", None),
        ("2017/10/02", None),
        ("2017-13-02", None),
        ("20171302", None),
        ("2017", None),
        ("2017", None),
        ("2017-02-30", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    assert one(spark, X.parse_timestamp(F.col("t")), t=text) == expected


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:  # this local time was skipped when the clocks changed
        key = X.date_key(X.parse_timestamp(F.col("t")))
        assert one(spark, key, t="2017-10-15 00:30:00") == 20171015
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_count_counts_midnights(spark):
    days = X.day_count(X.parse_timestamp(F.col("a")), X.parse_timestamp(F.col("b")))
    assert one(spark, days, a="2017-01-01 23:59:00", b="2017-01-02 00:01:00") == 1
    assert one(spark, days, a="2017-01-05 00:00:00", b="2017-01-02 23:00:00") == -3


def test_clean_place(spark):
    assert one(spark, X.clean_place(F.col("c")), c="  são paulo ") == "SÃO PAULO"
    assert one(spark, X.clean_place(F.col("c")), c="\trio") == "\tRIO"


def test_display(spark):
    assert one(spark, X.display(F.col("v")), v=None) == "-"
    assert one(spark, X.display(F.col("v")), v="3") == "3"


def test_default_calendar(spark):
    days = build_dim_date(spark)
    assert days.count() == 1828
    assert days.agg(F.min("date_key"), F.max("date_key")).first()[:] == (20160101, 20210101)


def order(**changes):
    row = {
        "order_id": "o1",
        "customer_id": "c1",
        "order_status": "delivered",
        "order_purchase_timestamp": "2017-01-01 10:00:00",
        "order_delivered_customer_date": "2017-01-10 15:00:00",
        "order_estimated_delivery_date": "2017-01-10 00:00:00",
    }
    return {**row, **changes}


def measures(spark, **changes):
    return fact.order_measures(frame(spark, "orders", order(**changes))).first()


def test_late_on_the_estimated_day(spark):
    row = measures(spark)
    assert (row.is_late, row.days_late, row.days_to_deliver) == (1, 0, 9)


def test_unparseable_delivery_date_is_delivered_without_key(spark):
    row = measures(spark, order_delivered_customer_date="soon")
    assert (row.is_delivered, row.delivered_date_key, row.is_late) == (1, None, 0)
    assert (row.days_to_deliver, row.days_late) == (None, None)


def test_undelivered(spark):
    row = measures(spark, order_delivered_customer_date=None, order_status="unavailable")
    assert (row.is_delivered, row.is_canceled, row.is_late) == (0, 1, 0)


def test_bad_purchase_date_is_reported_and_not_fatal(spark):
    assert measures(spark, order_purchase_timestamp="?").purchase_date_key is None


def test_first_payment_keeps_its_missing_type(spark):
    payments = frame(
        spark,
        "payments",
        dict(order_id="o", payment_sequential=2, payment_type="boleto", payment_installments=5,
             payment_value=Decimal("2.50")),
        dict(order_id="o", payment_sequential=1, payment_installments=3,
             payment_value=Decimal("1.25")),
    )
    row = fact.payment_per_order(payments).first()
    assert (row.payment_type, row.payment_installments) == (None, 3)
    assert row.payment_value == Decimal("3.75")


def tiny_star(spark, scores=(), orders=None, items=None):
    staging = {
        "orders": frame(spark, "orders", *(orders or [order()])),
        "order_items": frame(
            spark,
            "order_items",
            *(
                items
                or [
                    dict(order_id="o1", order_item_id=1, product_id="p1", seller_id="s1",
                         price=Decimal("10.10"), freight_value=Decimal("2.05"))
                ]
            ),
        ),
        "customers": frame(spark, "customers", dict(customer_id="c1", customer_unique_id="u1")),
        "products": frame(spark, "products", dict(product_id="p1")),
        "sellers": frame(spark, "sellers", dict(seller_id="s1")),
        "payments": frame(spark, "payments"),
        "reviews": frame(
            spark,
            "reviews",
            *[dict(review_id=str(i), order_id="o1", review_score=s) for i, s in enumerate(scores)],
        ),
        "category_translation": frame(spark, "category_translation"),
    }
    return build_star(staging, build_dim_date(spark), ordered=True)


@pytest.mark.parametrize(
    ("scores", "stored"), [((), 0), ((4, 5), 4), ((5, 5, 4), 4), ((5,) * 24 + (4,), 5)]
)
def test_review_score_is_rounded_to_a_tenth_and_cut_off(spark, scores, stored):
    row = tiny_star(spark, scores)["fact_sales"].first()
    assert row.review_score == stored
    assert row.line_total == Decimal("12.15")
    assert (row.payment_type, row.payment_value) == (None, None)


def test_lines_with_an_unknown_parent_are_dropped(spark):
    lines = [
        dict(order_id=o, order_item_id=i, product_id=p, seller_id="s1", price=Decimal(1),
             freight_value=Decimal(1))
        for i, (o, p) in enumerate([("o1", "p1"), ("o1", "p9"), ("o9", "p1")])
    ]
    star = tiny_star(spark, items=lines)
    assert star["fact_sales"].count() == 1
    assert star["fact_sales"].columns == [c.name for c in WAREHOUSE["fact_sales"].columns]
    assert star["fact_sales"].schema.simpleString() == WAREHOUSE["fact_sales"].schema.simpleString()


def test_unknown_category(spark):
    products = frame(
        spark,
        "products",
        dict(product_id="a", product_category_name="casa"),
        dict(product_id="b", product_category_name="outro"),
        dict(product_id="c"),
    )
    words = frame(
        spark,
        "category_translation",
        dict(product_category_name="casa", product_category_name_english="home"),
    )
    rows = build_dim_product(products, words).orderBy("product_sk").collect()
    assert [(r.product_sk, r.category_pt, r.category_en) for r in rows] == [
        (1, "casa", "home"),
        (2, "outro", "Unknown"),
        (3, "Unknown", "Unknown"),
    ]


def test_customer_numbering(spark):
    people = [dict(customer_id=c, customer_unique_id=u) for c, u in ["by", "ax", "ay", "bx"]]
    rows = build_dim_customer(frame(spark, "customers", *people)).orderBy("customer_sk").collect()
    assert [(r.customer_sk, r.customer_unique_id + r.customer_id) for r in rows] == [
        (1, "xa"),
        (2, "xb"),
        (3, "ya"),
        (4, "yb"),
    ]


# --- profile ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [
            ("ab  ", "2017-01-01", -5, Decimal("10.00"), 1.5, datetime.date(2020, 1, 2), True,
             datetime.datetime(2020, 1, 2, 3, 4, 5)),
            ("abc", "bad", 20, Decimal("9.50"), -2.5, datetime.date(2019, 1, 2), None,
             datetime.datetime(2021, 1, 2, 3, 4, 5)),
            (None, None, 3, Decimal("-100.25"), None, None, False, None),
            ("abc", "2017-01-02", 3, None, 30.0, None, False, None),
        ],
        "name string, some_date string, n int, d decimal(10,2), x double, day date, b boolean,"
        " at timestamp_ntz",
    )


def by_column(df):
    return {r.column_name: r for r in df.collect()}


@pytest.mark.parametrize("build", [profile, profile_approximate])
def test_profile_by_kind(spark, mixed, build):
    rows = by_column(build(mixed, "t"))
    assert set(rows) == set(mixed.columns)
    assert {r.total_rows for r in rows.values()} == {4}
    name = rows["name"]
    assert (name.distinct_cnt, name.null_cnt, name.min_val, name.avg_length) == (2, 1, None, 2.0)
    date = rows["some_date"]
    assert (date.min_val, date.max_val, date.invalid_date) == ("2017-01-01", "bad", 1)
    n = rows["n"]
    assert (n.min_val, n.max_val, n.avg_val, n.negative_cnt) == ("-5", "20", 5.25, 1)
    d = rows["d"]
    assert (d.min_val, d.max_val, d.negative_cnt, d.distinct_cnt) == ("-100.25", "10.00", 1, 3)
    x = rows["x"]
    assert (float(x.min_val), float(x.max_val), x.null_cnt) == (-2.5, 30.0, 1)
    day = rows["day"]
    assert (day.min_val, day.max_val, day.null_cnt) == ("2019-01-02", "2020-01-02", 2)
    at = rows["at"]
    assert (at.min_val, at.max_val) == ("2020-01-02 03:04:05", "2021-01-02 03:04:05")
    b = rows["b"]
    assert (b.distinct_cnt, b.null_cnt, b.min_val, b.avg_val) == (2, 1, None, None)


@pytest.mark.parametrize("build", [profile, profile_approximate])
def test_profile_of_an_empty_table_and_an_empty_column(spark, build):
    empty = by_column(build(frame(spark, "orders"), "orders"))["order_id"]
    assert (empty.total_rows, empty.distinct_cnt, empty.null_cnt) == (0, 0, None)
    assert empty.avg_length is None
    blank = by_column(build(frame(spark, "sellers", dict(seller_id="s")), "sellers"))
    assert blank["seller_city"].avg_length is None
    assert blank["seller_city"].null_cnt == 1


def test_approved_at_is_plain_text_unless_named(spark):
    orders = frame(spark, "orders", order(order_approved_at="x"))
    assert by_column(profile(orders, "orders"))["order_approved_at"].invalid_date is None
    named = by_column(profile(orders, "orders", ["order_approved_at"]))["order_approved_at"]
    assert named.invalid_date == 1


@pytest.mark.parametrize("build", [profile, profile_approximate])
def test_profile_of_odd_column_names(spark, build):
    df = spark.createDataFrame([(1, "x")], "`a.b` int, `c d` string")
    rows = by_column(build(df, "t"))
    assert rows["a.b"].max_val == "1" and rows["c d"].avg_length == 1.0


def test_rendered_profile(spark, mixed):
    rows = render_profile(profile(mixed, "t")).collect()
    assert [r.column_name for r in rows] == sorted(mixed.columns)
    shown = {r.column_name: r for r in rows}
    assert shown["name"].avg_val == "-"
    assert shown["name"].min_val is None
    assert shown["n"].negative_cnt == "1"


# --- checks ----------------------------------------------------------------------------------


def test_primary_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows_of(I.primary_key_violations(df, "k")) == sorted([("2", "1"), ("1", "~")])


def test_foreign_key_violations(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "f int")
    parent = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows_of(I.foreign_key_violations(child, "f", parent, "k")) == [("2", "1")]


def test_orphans_include_missing_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "order_id string")
    parent = spark.createDataFrame([("a",)], "order_id string")
    assert rows_of(I.orphan_counts(child, parent, "order_id")) == [("1", "~"), ("2", "b")]


def test_required_and_length_reports(spark):
    sellers = frame(
        spark,
        "sellers",
        dict(seller_id=None, seller_state="ABC"),
        dict(seller_id="x" * 51, seller_zip_code_prefix="01001"),
    )
    required = I.not_null_violations(sellers, STAGING["sellers"])
    assert rows_of(required) == [("seller_id", "1", "sellers")]
    sizes = {r.column_name: r.too_large_rows for r in
             I.length_violations(sellers, STAGING["sellers"]).collect()}
    assert sizes == {
        "seller_id": 1,
        "seller_zip_code_prefix": 0,
        "seller_city": 0,
        "seller_state": 1,
    }


def test_declared_required_columns():
    counts = {n: len(t.required) for n, t in {**STAGING, **WAREHOUSE}.items()}
    assert sum(counts[n] for n in STAGING) == 20
    assert sum(counts[n] for n in WAREHOUSE) == 13


# --- exploration -----------------------------------------------------------------------------


def test_describe_matches_pandas(spark):
    values = [Decimal(v) for v in ("1.10", "2.20", "2.20", "7.00", "9.99", "120.00", "3.30")]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "price decimal(10,2)")
    import pandas as pd

    expected = pd.Series([float(v) for v in values]).describe()
    row = E.describe(df, "price").first()
    assert row["count"] == 7
    for ours, theirs in {"mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%",
                         "p75": "75%", "max": "max"}.items():
        assert row[ours] == pytest.approx(expected[theirs])


def test_describe_of_many_values_and_of_none(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("(id * 7919) % 10007 as v")
    values = df.toPandas()["v"].describe()
    row = E.describe(df, "v").first()
    assert row.p25 == values["25%"] and row.p75 == values["75%"]
    assert row.std == pytest.approx(values["std"])
    nothing = E.describe(df.where("v < 0"), "v").first()
    assert nothing["count"] == 0 and nothing.p50 is None and nothing["std"] is None


def test_missing_percentage_rounds_half_to_even(spark):
    df = spark.range(0, 800).selectExpr("case when id > 0 then id end as a", "id as b")
    rows = E.missing_values(df).collect()
    assert [(r.column_name, r.missing_count, r.missing_percentage) for r in rows] == [
        ("a", 1, 0.12),
        ("b", 0, 0.0),
    ]
    assert [r.column_name for r in E.columns_with_missing(df).collect()] == ["a"]


def test_difference_and_anti_join_disagree_with_orphans(spark):
    child = spark.createDataFrame([("a",), ("z",)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    names = ("used", "all", "unused")
    row = E.with_difference(E.key_coverage(child, parent, "k", *names[:2]), *names).first()
    assert row.unused == 1
    assert I.unreferenced_count(parent, child, "k", "n").first().n == 2


def test_value_counts_skip_missing_and_order_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in E.value_counts(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [r.v for r in E.top_values(df, "v", 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("rows, reach", [(1_000_000, 0.001), (40, 0.001), (40, 0.0)])
def test_describe_narrows_brackets(spark, monkeypatch, rows, reach):
    """Whatever the brackets, the quartiles are exact, with ties and with a value that holds half of the rows."""
    import numpy as np

    from mercaloom.operators import explore

    monkeypatch.setattr(explore, "BRACKET_ROWS", rows)
    monkeypatch.setattr(explore, "REACH", reach or 0.0001)
    rng = np.random.default_rng(1)
    for values in (rng.normal(0, 1, 3000), rng.integers(0, 5, 999), np.r_[np.zeros(500), rng.normal(0, 1, 501)], np.array([3.5])):
        frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "`a.b` double")
        row = explore.describe(frame, "a.b").first()
        assert row["count"] == len(values) and row["min"] == values.min() and row["max"] == values.max()
        for name, share in explore.QUARTILES.items():
            assert row[name] == pytest.approx(np.quantile(values, share), abs=1e-12)
    assert explore.describe(frame.where("`a.b` is null"), "a.b").first()["count"] == 0


def test_odd_column_names(spark):
    from mercaloom.operators import explore

    odd = spark.createDataFrame([(1, None), (None, "x")], "`a.b` int, `c d` string")
    assert {r.column_name: r.missing_count for r in explore.missing_values(odd).collect()} == {"a.b": 1, "c d": 1}
    assert [tuple(r) for r in explore.value_counts(odd, "a.b").collect()] == [(1, 1)]


def test_profile_sorts_nothing_and_shuffles_values_once(spark):
    """No sort on either side of a shuffle; texts' extremes take one row for the whole table."""
    wide = spark.range(2000).selectExpr(
        "id", "cast(id as decimal(10,2)) d", "cast(id as float) / 4 f", "'t' || id t", "'2018-01-0' || (id % 9 + 1) some_date",
        "cast('2018-01-01' as timestamp_ntz) + make_dt_interval(cast(id as int)) m", "id % 2 = 0 b",
    )
    found = profile(wide, "wide")
    rows = {r.column_name: r for r in found.collect()}
    assert (rows["d"].min_val, rows["d"].max_val) == ("0.00", "1999.00")
    assert (rows["f"].min_val, rows["f"].max_val, rows["f"].avg_val) == ("0.0", "499.75", 249.875)
    assert (rows["id"].max_val, rows["some_date"].max_val) == ("1999", "2018-01-09")
    assert (rows["m"].min_val, rows["m"].max_val) == ("2018-01-01 00:00:00", "2023-06-23 00:00:00")
    assert (rows["b"].distinct_cnt, rows["b"].min_val, rows["t"].min_val) == (2, None, None)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Sort [" not in plan and "SortAggregate(key=[c" not in plan and "ReusedExchange" in plan


@pytest.mark.parametrize("kind", ["few", "many", "large"])
def test_first_payment_as_one_number(spark, kind, monkeypatch):
    if kind == "many":
        monkeypatch.setattr(fact, "MOST_KINDS", 1)
    big = 3_000_000_000 if kind == "large" else -7
    rows = [("a", 2, "voucher", 1, 1), ("a", 1, None, None, 2), ("a", 1, "boleto", 3, 4), ("b", 1, "é", 5, 8), ("b", 1, "z", 4, 1),
            ("c", -3, "boleto", -2, 1), ("c", -3, "boleto", big, 1), ("d", 1, None, 9, None)]
    payments = spark.createDataFrame(rows, "order_id string, payment_sequential long, payment_type string, payment_installments long, payment_value int")
    found = fact.payment_per_order(payments.withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)")))
    least = -2 if kind == "large" else -7
    got = {r.order_id: (r.payment_type, r.payment_installments, r.payment_value) for r in found.collect()}
    assert got == {"a": (None, None, 7), "b": ("z", 4, 9), "c": ("boleto", least, 2), "d": (None, 9, None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) == (kind != "few")


def test_first_payment_without_a_sequence_number(spark):
    schema = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(10,2)"
    rows = [("a", None, "boleto", 1, None), ("a", 1, "boleto", 2, None)]
    assert fact.payment_per_order(spark.createDataFrame(rows, schema)).first().payment_installments == 1
    assert fact.payment_per_order(spark.createDataFrame([], schema)).count() == 0
