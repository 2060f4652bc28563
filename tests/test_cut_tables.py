"""Tables cut by a column: pruning, numbers, refreshes of single values; the fact cut by month."""

import datetime

import pytest
from pyspark.sql import functions as F

from mercaloom.plans import kpis, pipeline
from mercaloom.sources import cut_tables as C
from mercaloom.sources import tables as T
from mercaloom.sources.schemas import WAREHOUSE
from tests.conftest import rows_of

SCHEMA = "month int, v long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA).repartitionByRange(3, "month").sortWithinPartitions("month")


def files_read(df):
    """How many files of the table a query opened, and how many each folder holds."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ran = df.select("*")
        ran.collect()
        leaves = ran._jdf.queryExecution().executedPlan().collectLeaves()
        found = 0
        for i in range(leaves.size()):
            if "month" in leaves.apply(i).schema().toDDL():
                found += leaves.apply(i).metrics().get("numFiles").get().value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = {}
    for f in df.inputFiles():
        if "month=" in f:
            sizes[f.rpartition("/")[0]] = sizes.get(f.rpartition("/")[0], 0) + 1
    return found, sizes


def reads_only(df, *values):
    """Whether the files opened are those of the newest folder of each value and no more."""
    found, sizes = files_read(df)
    names = {f"month={v}" for v in values}
    return found > 0 and found in {sum(n for f, n in sizes.items() if f.rpartition("/")[2].endswith(tuple(names)) and keep in f)
                                   for keep in {f.rpartition("/")[0] for f in sizes}}


@pytest.fixture()
def cut(spark):
    T.create_databases(spark)
    rows = [(m, i) for m in (None, 1, 2, 3) for i in range(50)]
    yield C.save_cut(frame(spark, *rows), "staging", "cut", "sk", "month")
    spark.sql("DROP VIEW IF EXISTS staging.cut")


def content(df):
    return sorted(((r.month, r.v) for r in df.collect()), key=str)


def numbers(df):
    return sorted(r.sk for r in df.select("sk").collect())


def test_numbers_and_pruning(spark, cut):
    assert numbers(cut) == list(range(1, 201)) and cut.columns == ["sk", "month", "v"]
    assert reads_only(cut.where("month = 2"), 2)
    assert reads_only(cut.where("month is null"), "__HIVE_DEFAULT_PARTITION__") and not reads_only(cut, 2)
    assert cut.where("month = 2").count() == 50


def test_refresh_of_single_values(spark, cut):
    before = {r.sk: (r.month, r.v) for r in cut.collect()}
    now = C.refresh_cut(frame(spark, (2, 7), (2, 8), (4, 9)), "staging", "cut", "sk", "month", [2, 4, 5])
    want = [(m, i) for m in (None, 1, 3) for i in range(50)] + [(2, 7), (2, 8), (4, 9)]
    assert content(now) == sorted(want, key=str)
    after = {r.sk: (r.month, r.v) for r in now.collect()}
    assert all(before[k] == v for k, v in after.items() if k <= 200) and sorted(k for k in after if k > 200) == [201, 202, 203]
    assert reads_only(now.where("month = 1"), 1) and len(C.contents_of(spark, "staging", "cut")) == 2
    now = C.refresh_cut(frame(spark, (None, 1)), "staging", "cut", "sk", "month", [None])
    assert now.where("month is null").count() == 1 and now.count() == 50 * 2 + 3 + 1
    now = C.refresh_cut(frame(spark, (5, 1)), "staging", "cut", "sk", "month", [2, 4, 5])  # 2 and 4 go, the second content too
    assert content(now) == sorted([(m, i) for m in (1, 3) for i in range(50)] + [(None, 1), (5, 1)], key=str)
    assert len(C.contents_of(spark, "staging", "cut")) == 3 and len(set(numbers(now))) == 102
    kept = {c["folder"].rpartition("/")[2] for c in C.contents_of(spark, "staging", "cut")}
    assert {s.getPath().getName() for s, _ in T._contents(spark, T._new_folder(spark, "staging", "cut"))} == kept


def test_a_refresh_holds_no_other_values(spark, cut):
    with pytest.raises(Exception, match="not among those to refresh"):
        C.refresh_cut(frame(spark, (2, 7), (3, 8)), "staging", "cut", "sk", "month", [2])
    with pytest.raises(Exception, match="not among those to refresh"):
        C.refresh_cut(frame(spark, (None, 7)), "staging", "cut", "sk", "month", [2])
    assert spark.table("staging.cut").count() == 200
    with pytest.raises(ValueError, match="not a cut table"):
        C.refresh_cut(frame(spark), "staging", "nowhere", "sk", "month", [2])


def test_empty_contents(spark, cut):
    assert C.refresh_cut(frame(spark), "staging", "cut", "sk", "month", [1, 2]).count() == 100
    assert C.save_cut(frame(spark), "staging", "cut", "sk", "month").count() == 0
    assert C.refresh_cut(frame(spark, (9, 9)), "staging", "cut", "sk", "month", [9]).count() == 1


def test_the_fact_cut_by_month(spark, staging):
    days = datetime.date(1995, 1, 1), datetime.date(2002, 12, 31)
    star = pipeline.build_warehouse(spark, staging, *days, by_month=True)
    fact = star["fact_sales"]
    summary = fact.agg(F.min("sales_sk"), F.max("sales_sk"), F.count_distinct("sales_sk")).first()
    n = summary[1]
    assert tuple(summary) == (1, n, n) and fact.count() == n
    assert T.counts_of(spark, "warehouse", "fact_sales")["rows"] == n
    of_month = kpis.of_months(star, 199703)
    assert reads_only(of_month["fact_sales"], 199703)
    plain = {**star, "fact_sales": fact.drop("purchase_month").where("purchase_date_key between 19970300 and 19970399")}
    for figure in (kpis.revenue_lines, kpis.delivery_time, kpis.top_state, kpis.revenue_by_month):
        assert rows_of(figure(of_month)) == rows_of(figure(plain))
    whole = {r.purchase_month: r.revenue for r in kpis.revenue_by_month(star).collect()}
    assert kpis.revenue_lines(of_month).first().total_revenue == whole[199703]

    # orders of a month are corrected; the month is rebuilt, all other rows keep their numbers
    late = F.col("order_purchase_timestamp").startswith("1997-03")
    orders = staging["orders"].withColumn("order_status", F.when(late, "corrected").otherwise(F.col("order_status")))
    before = rows_of(fact.where("purchase_month <> 199703"))
    lines = fact.where("purchase_month = 199703").count()
    now = pipeline.refresh_months(spark, {**staging, "orders": orders}, [199703])
    assert rows_of(now.where("purchase_month <> 199703")) == before
    changed = now.where("purchase_month = 199703")
    assert changed.count() == lines and {r.order_status for r in changed.select("order_status").distinct().collect()} == {"corrected"}
    assert changed.agg(F.min("sales_sk")).first()[0] == n + 1 and reads_only(changed, 199703)
    assert set(WAREHOUSE) <= set(T.list_tables(spark, "warehouse"))
