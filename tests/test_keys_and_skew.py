"""Parallel numbering and skewed joins, also with a third of all rows under one key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercaloom.operators.keys import grouped_row_number, ordered_row_number, ranges_by, row_identity
from mercaloom.operators import skew
from mercaloom.operators.skew import (
    NOT_SKEWED,
    HotKeys,
    Lookup,
    find_hot_keys,
    look_up,
    skew_safe_join,
)
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows over 8 partitions; one third has the key 'hot', a tenth has none."""
    return spark.range(0, 30_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else 'k' || (id % 997) end key",
        "id % 50 as a",
        "id as b",
    )


def spread_of(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_ordered_row_number_equals_global_window(spark, skewed, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = ordered_row_number(skewed, "sk", "key", "a", "b")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (len(got.inputFiles()) > 4) == (coalesce == "false")
    expected = skewed.withColumn("sk", F.row_number().over(Window.orderBy("key", "a", "b")))
    assert rows_of(got) == rows_of(expected)


def test_ties_are_numbered_without_gaps_and_spread(spark):
    copies = spark.range(0, 40_000, 1, 16).selectExpr(
        "case when id % 3 > 0 then 'copy' else 'v' || id end as v"
    )
    got = ordered_row_number(copies, "sk", "v")
    summary = got.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(summary) == (1, 40_000, 40_000)
    before = got.select("v", F.lag("v").over(Window.orderBy("sk")).alias("p"))
    assert before.where("p > v").count() == 0


def test_copies_do_not_share_one_range(spark):
    copies = spark.range(0, 64_000, 1, 16).select(F.lit("same").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tied = copies.withColumn("_tie", F.spark_partition_id()).repartitionByRange("v", "_tie")
        assert max(spread_of(tied)) <= 64_000 // 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbers_stay_the_same_when_read_again(spark, skewed):
    got = ordered_row_number(skewed.drop("b"), "sk", "key")
    assert rows_of(got) == rows_of(got)


def test_row_identity(spark, skewed):
    got = row_identity(skewed, "sk")
    summary = got.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(summary) == (1, 30_000, 30_000)
    assert rows_of(got.drop("sk")) == rows_of(skewed)
    assert "Exchange rangepartitioning" not in got._jdf.queryExecution().toString()


def test_numbering_an_empty_table(spark, skewed):
    empty = skewed.where("a < 0")
    assert ordered_row_number(empty, "sk", "key").count() == 0


@pytest.mark.parametrize("sample_rows", [200, 1000])
def test_hot_keys_are_found(spark, skewed, monkeypatch, sample_rows):
    monkeypatch.setattr(skew, "SAMPLE_ROWS_PER_TASK", sample_rows)
    found = find_hot_keys(skewed, "key", "a", min_rows=1000)
    assert set(found["key"].spread) == {"hot"}
    assert found["key"].spread["hot"] >= 3  # a third of eight tasks
    assert found["key"].null_spread == 1  # seven per cent have no key: less than two fair shares
    assert not found["a"]


def test_small_tables_have_no_hot_keys(spark, skewed):
    assert find_hot_keys(skewed, "key")["key"] is NOT_SKEWED


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_join_equals_plain_join(spark, skewed, how):
    right = spark.range(0, 900).selectExpr(
        "case when id = 0 then 'hot' when id = 1 then null else 'k' || id end as key", "id as c"
    )
    right = right.unionByName(right.where("c < 3"))  # repeated parents fan out as in a plain join
    hot = find_hot_keys(skewed, "key", min_rows=1000)["key"]
    assert hot
    got = skew_safe_join(skewed, right, "key", how, hot)
    assert rows_of(got) == rows_of(skewed.join(right, "key", how))


def test_skewed_join_spreads_the_hot_key(spark, skewed):
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, c int")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        hot_rows = skewed.where("key = 'hot'")
        plain = skew_safe_join(hot_rows, right, "key")
        salted = skew_safe_join(hot_rows, right, "key", hot=HotKeys({"hot": 64}))
        assert len(spread_of(plain)) == 1
        assert len(spread_of(salted)) == 8
        assert max(spread_of(salted)) < 10_000 // 3
        copies = hot_rows.select("key")
        spread = skew_safe_join(copies, right, "key", hot=HotKeys({"hot": 64}))
        assert len(spread_of(spread)) >= 4
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_rows_without_a_key_spread_in_a_left_join(spark):
    left = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, 'k' || id, null) key", "id")
    right = spark.createDataFrame([("k3", 1)], "key string, c int")
    hot = find_hot_keys(left, "key", min_rows=1000)["key"]
    assert hot and not hot.spread and hot.null_spread >= 5
    for how in ("left", "inner"):
        got = skew_safe_join(left, right, "key", how, hot)
        assert rows_of(got) == rows_of(left.join(right, "key", how))


@pytest.mark.parametrize("size", [0, 10**6])
def test_look_up_broadcasts_only_what_is_small(spark, skewed, size):
    right = spark.range(0, 900).selectExpr("'k' || id as key", "id as c")
    other = spark.range(0, 50).selectExpr("id as a", "'x' || id as label")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = look_up(skewed, Lookup("key", right, "left"), Lookup("a", other), min_rows=1000, broadcast_bytes=size)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (size == 0)
        assert rows_of(got) == rows_of(skewed.join(right, "key", "left").join(other, "a"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_narrow_parents_are_broadcast_and_wide_ones_are_not(spark, skewed):
    narrow = spark.range(0, 310_000).selectExpr("'k' || id as key", "id as c")
    wide = spark.range(0, 2000).selectExpr("'k' || id as key", "repeat('x', 200000) as c")

    def shuffles(parent, size):
        plan = look_up(skewed, Lookup("key", parent, "left"), min_rows=1000, broadcast_bytes=size)
        text = plan._jdf.queryExecution().executedPlan().toString()
        return text.count("Exchange hashpartitioning")

    assert shuffles(narrow, skew.BROADCAST_BYTES) == 0
    assert shuffles(wide, skew.BROADCAST_BYTES) == 2
    assert skew.measured_bytes(wide) > 400_000_000 > 100 * 310_000 > skew.measured_bytes(narrow) > 310_000 * 8


def test_only_the_missing_key_is_hot(spark):
    rows = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, 'k' || id, null) key", "id as a")
    hot = HotKeys(null_spread=6)
    got = grouped_row_number(rows, "n", "key", "a", hot=hot)
    window = Window.partitionBy("key").orderBy("a")
    assert rows_of(got) == rows_of(rows.withColumn("n", F.row_number().over(window)))
    # they are read from what the range shuffle stored, not from the window
    window_rows = got.where("key is null")._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in window_rows and got.where("key is null").count() == 6000


def test_other_join_types_are_refused(skewed):
    with pytest.raises(ValueError):
        skew_safe_join(skewed, skewed, "key", "full")


@pytest.mark.parametrize("min_rows", [1000, 10**9])
def test_grouped_row_number(spark, skewed, min_rows):
    hot = find_hot_keys(skewed, "key", min_rows=min_rows)["key"]
    got = grouped_row_number(skewed, "n", "key", "a", "b", hot=hot)
    window = Window.partitionBy("key").orderBy("a", "b")
    assert rows_of(got) == rows_of(skewed.withColumn("n", F.row_number().over(window)))


def test_star_with_hot_keys_equals_star_without(spark, small, monkeypatch):
    """The whole build with salting forced on gives the same tables."""
    import datetime

    from mercaloom.plans.dimensions import build_dim_date
    from mercaloom.plans.kpis import revenue_by_category_state
    from mercaloom.plans.pipeline import build_star
    from mercaloom.sources.fixtures import StagingTables, read_source_tables

    calendar = build_dim_date(spark, datetime.date(1995, 1, 1), datetime.date(2002, 12, 31))
    source = read_source_tables(spark, small)
    # One order, one customer, one part and one supplier get a third of all lines or orders.
    source["lineitem"] = source["lineitem"].selectExpr(
        "case when l_orderkey % 3 = 0 then 6 else l_orderkey end l_orderkey",
        "case when l_partkey % 3 = 0 then 7 else l_partkey end l_partkey",
        "case when l_suppkey % 3 = 0 then 5 else l_suppkey end l_suppkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
        "l_shipdate",
    )
    source["orders"] = source["orders"].withColumn(
        "o_custkey", F.expr("case when o_orderkey % 3 = 0 then 1 else o_custkey end")
    )
    results = []
    for min_rows in (100, 10**9):
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0 if min_rows == 100 else 10**8)
        staged = StagingTables(source, min_rows)
        star = build_star(staged, calendar, ordered=True, min_hot_rows=min_rows)
        results.append(
            [rows_of(star[t]) for t in sorted(star)]
            + [rows_of(revenue_by_category_state(star, min_rows))]
        )
    assert results[0] == results[1]


def test_lines_are_shuffled_once_for_their_numbers_and_their_orders(spark, staging):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = staging["order_items"].join(staging["orders"].select("order_id", "order_status"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Window" in plan and plan.count("Exchange hashpartitioning") == 2  # one of the lines, one of the orders


@pytest.mark.parametrize("min_rows", [1000, 1_000_000])
def test_ranges_from_keys_run_their_input_once(spark, skewed, min_rows, monkeypatch):
    from mercaloom.operators import keys

    monkeypatch.setattr(keys, "LEAST_RANGE_ROWS", 1000)
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = skewed.union(skewed.limit(0)).mapInArrow(seen, skewed.schema)
    got = row_identity(ranges_by(skewed, rows, "key", "a", "b", min_rows=min_rows), "sk")
    expected = skewed.withColumn("sk", F.row_number().over(Window.orderBy("key", "a", "b")))
    assert rows_of(got) == rows_of(expected)
    if min_rows > 1000:  # else a third of all rows has one key, and the plain range shuffle spreads it
        assert runs.value == skewed.count() and len(got.inputFiles()) > 4
    assert row_identity(ranges_by(skewed.limit(0), rows.limit(0), "key", "a"), "sk").count() == 0
