"""CSV dialect, rejected rows, saved tables and the whole pipeline."""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercaloom.operators.integrity import check_integrity
from mercaloom.plans import pipeline
from mercaloom.sources import tables as T
from mercaloom.sources.csv_files import accepted, read_table, rejected
from mercaloom.sources.schemas import STAGING, WAREHOUSE
from tests.conftest import rows_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


def write(folder, name, text, bom=False):
    path = folder / name
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def test_byte_order_mark(spark, tmp_path):
    text = "product_category_name,product_category_name_english\ncama,bed\n"
    path = write(tmp_path, "t.csv", text, bom=True)
    rows = accepted(read_table(spark, "category_translation", path)).collect()
    assert [tuple(r) for r in rows] == [("cama", "bed")]


def test_multi_line_quoted_text(spark, tmp_path):
    text = (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,NA,"line one\nline ""two"", end",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,4.0,,null,2018-01-19 00:00:00,\n"
    )
    path = write(tmp_path, "r.csv", text)
    rows = accepted(read_table(spark, "reviews", path)).orderBy("review_id").collect()
    assert rows[0].review_comment_message == 'line one\nline "two", end'
    assert rows[0].review_comment_title is None
    assert rows[1].review_score == 4
    assert rows[1].review_comment_message is None and rows[1].review_answer_timestamp is None
    kept = read_table(spark, "reviews", path, column_tokens={"review_comment_title": [""]})
    assert accepted(kept).where("review_id = 'r1'").first().review_comment_title == "NA"


def test_headers_are_renamed_and_matched_by_name(spark, tmp_path):
    text = (
        "product_width_cm,product_id,product_category_name,product_name_lenght,"
        "product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,"
        "product_height_cm\n14,p1,perfumaria,40,287,1,225.0,16,10\n"
    )
    row = accepted(read_table(spark, "products", write(tmp_path, "p.csv", text))).first()
    assert (row.product_name_length, row.product_width_cm, row.product_weight_g) == (40, 14, 225)


def test_unknown_header_is_an_error(spark, tmp_path):
    path = write(tmp_path, "s.csv", "seller_id,city\ns1,x\n")
    with pytest.raises(ValueError, match="seller_city"):
        read_table(spark, "sellers", path)


def test_zip_codes_keep_leading_zeros(spark, tmp_path):
    text = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01001,são paulo,SP\n"
    row = accepted(read_table(spark, "sellers", write(tmp_path, "s.csv", text))).first()
    assert (row.seller_zip_code_prefix, row.seller_city) == ("01001", "são paulo")


def test_rejected_rows_say_why(spark, tmp_path):
    text = ITEMS + (
        "o1,1,p1,s1,2017-09-19 09:45:35,58.905,13.29\n"
        "o2,x,p1,s1,2017-09-19 09:45:35,58.90,13.29\n"
        "o3,1,,s1,2017-09-19 09:45:35,cheap,13.29\n"
        "o4,1,p1\n"
    )
    prepared = read_table(spark, "order_items", write(tmp_path, "i.csv", text))
    good = accepted(prepared).collect()
    assert [(r.order_id, r.price) for r in good] == [("o1", Decimal("58.91"))]
    bad = {r.record.split(",")[0]: r for r in rejected(prepared).collect()}
    assert bad["o2"].reasons == ["order_item_id: not int"]
    assert bad["o3"].reasons == ["product_id: missing", "price: not decimal(10,2)"]
    assert "malformed record" in bad["o4"].reasons
    assert bad["o2"].file.endswith("i.csv")


def test_too_long_text_is_rejected(spark, tmp_path):
    text = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,ABC\n"
    prepared = read_table(spark, "sellers", write(tmp_path, "s.csv", text))
    assert rejected(prepared).first().reasons == ["seller_state: over 2 long"]


def test_failed_load_keeps_the_old_table(spark, tmp_path):
    T.create_databases(spark)
    line = "o1,1,p1,s1,2017-09-19 09:45:35,5.00,1.00\n"
    good = write(tmp_path, "good.csv", ITEMS + line)
    bad = write(tmp_path, "bad.csv", ITEMS + line + line.replace("5.00", "?"))
    T.load_table(spark, "order_items", good)
    with pytest.raises(T.LoadError, match="price"):
        T.load_table(spark, "order_items", bad)
    assert spark.table("staging.order_items").count() == 1
    T.load_table(spark, "order_items", bad, on_reject="quarantine")
    assert spark.table("staging.order_items_rejected").count() == 1
    with pytest.raises(ValueError):
        T.load_table(spark, "order_items", good, on_reject="ignore")


def test_a_later_load_leaves_no_old_rejects(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    for folder, text in ((good, "s1,1,a,SP\n"), (bad, "s1,1,a,SP\ns2,2,b,TOOLONG\n")):
        folder.mkdir()
        (folder / "sellers.csv").write_text(header + text)
    T.create_databases(spark)
    T.load_table(spark, "sellers", str(bad), on_reject="quarantine")
    assert spark.table("staging.sellers_rejected").first().reasons == ["seller_state: over 2 long"]
    assert spark.table("staging.sellers").count() == 1
    T.load_table(spark, "sellers", str(good))
    assert "sellers_rejected" not in T.list_tables(spark, "staging")
    T.load_table(spark, "sellers", str(good), on_reject="quarantine")
    assert spark.table("staging.sellers_rejected").count() == 0


def test_a_failed_write_leaves_the_old_rows(spark):
    T.create_databases(spark)
    T.save_table(spark.range(3), "staging", "kept")
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") > 900, F.raise_error(F.lit("halfway"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="halfway"):
        T.save_table(broken, "staging", "kept")
    assert spark.table("staging.kept").count() == 3
    T.save_table(spark.table("staging.kept").selectExpr("id + 1 as id"), "staging", "kept")  # from itself
    assert rows_of(spark.table("staging.kept")) == [("1",), ("2",), ("3",)]
    T.save_table(spark.range(2).selectExpr("'a' as other"), "staging", "kept")
    assert spark.table("staging.kept").columns == ["other"]
    spark.sql("DROP TABLE staging.kept")


RERUN = """
import sys
from mercaloom.session import build_session
from mercaloom.plans import pipeline
import datetime
spark = build_session("rerun", "local[2]", **{"spark.sql.warehouse.dir": sys.argv[2], "spark.checkpoint.dir": sys.argv[3],
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 2, "spark.driver.memory": "2g"})
saved = pipeline.run(spark, sys.argv[1], start=datetime.date(1995, 1, 1), end=datetime.date(2002, 12, 31))
print("fact rows", saved["fact_sales"].count())
"""


def test_run_again_in_another_process(csv_folder, tmp_path):
    """The default catalog of a new process knows no table; the folders of the first are replaced."""
    import subprocess
    import sys

    counts = []
    for _ in range(2):
        done = subprocess.run(
            [sys.executable, "-c", RERUN, csv_folder, str(tmp_path / "warehouse"), str(tmp_path / "shared")],
            capture_output=True, text=True, timeout=600, cwd=str(tmp_path), env={**os.environ, "PYTHONPATH": ROOT},
        )
        assert done.returncode == 0, done.stderr[-2000:]
        counts.append(done.stdout.split("fact rows")[1].strip())
    assert counts[0] == counts[1]
    folders = [f for f in os.listdir(tmp_path / "warehouse" / "warehouse.db") if f.startswith("fact_sales__")]
    assert len(folders) == 1


def test_two_sessions_save_the_same_table(spark):
    """The second session saves while the first still writes; no rows are lost and one whole content is left."""
    T.create_databases(spark)
    T.save_table(spark.range(5), "staging", "shared")
    other = spark.newSession()
    done = []

    def meanwhile(n):
        if not done:
            done.append(True)
            T.save_table(other.range(7), "staging", "shared")
        return n

    first = T._point

    def point(spark, database, name, schema, folder):
        meanwhile(0)  # the first session has written its rows and not pointed the table at them yet
        return first(spark, database, name, schema, folder)

    T._point = point
    try:
        T.save_table(spark.range(9), "staging", "shared")
    finally:
        T._point = first
    assert spark.table("staging.shared").count() == 9
    folder = T._new_folder(spark, "staging", "shared")
    kept = T._contents(spark, folder)
    assert len(kept) == 1 and kept[0][1]
    # the other way round: pointed at by another session after this one, so not this one's to delete
    path, files = T._path(spark, folder)
    spark.range(3).write.parquet(folder)
    assert T.drop_unfinished(spark, "staging", "shared", 0) == 0
    T.save_table(spark.range(2), "staging", "shared")
    assert files.exists(path) and spark.table("staging.shared").count() == 2
    assert T.drop_unfinished(spark, "staging", "shared", 1 << 60) == 1 and not files.exists(path)
    spark.sql("DROP TABLE staging.shared")


def test_the_fact_is_written_once_and_numbered(spark):
    T.create_databases(spark)
    for rows in (0, 1000):
        df = spark.range(0, rows, 1, 7).selectExpr("id", "'x' as v")
        for _ in range(2):
            saved = T.save_numbered(df, "staging", "numbered", "sk")
        found = saved.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk"), F.count_if(F.col("sk") == F.col("id") + 1)).first()
        assert tuple(found) == ((1, rows, rows, rows) if rows else (None, None, 0, 0))
        assert [len(T._contents(spark, T._new_folder(spark, "staging", n))) for n in ("numbered", "numbered_files")] == [1, 1]
    T.save_table(df, "staging", "numbered")  # a table in place of the view, and back
    assert T.save_numbered(df, "staging", "numbered", "sk").count() == 1000
    spark.sql("DROP VIEW staging.numbered")


def test_append_rows_matches_by_name(spark):
    T.create_databases(spark)
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    T.save_table(first, "staging", "extra")
    T.append_rows(spark.createDataFrame([("b", 2)], "v string, k int"), "staging", "extra")
    assert rows_of(spark.table("staging.extra")) == [("1", "a"), ("2", "b")]
    spark.sql("DROP TABLE staging.extra")


FIRST_DAY, LAST_DAY = datetime.date(1995, 1, 1), datetime.date(2002, 12, 31)

FILES = {
    "customers": "shop_customers_dataset.csv",
    "products": "shop_products_dataset.csv",
    "sellers": "shop_sellers_dataset.csv",
    "orders": "shop_orders_dataset.csv",
    "order_items": "shop_order_items_dataset.csv",
    "geolocation": "shop_geolocation_dataset.csv",
    "payments": "shop_order_payments_dataset.csv",
    "reviews": "shop_order_reviews_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


@pytest.fixture(scope="module")
def csv_folder(staging, tmp_path_factory):
    """The adapter's tables as CSV files, one of them in parts."""
    folder = tmp_path_factory.mktemp("csv")
    for name, file in FILES.items():
        frame = staging[name].toPandas()
        if name == "orders":
            half = len(frame) // 2
            frame[:half].to_csv(folder / file.replace(".csv", "-1.csv"), index=False)
            frame[half:].to_csv(folder / file.replace(".csv", "-2.csv"), index=False)
        else:
            frame.to_csv(folder / file, index=False)
    return str(folder)


@pytest.fixture(scope="module")
def saved(spark, csv_folder):
    return pipeline.run(spark, csv_folder, start=FIRST_DAY, end=LAST_DAY)


@pytest.fixture(scope="module")
def loaded(spark, saved):
    return T.saved_tables(spark, "staging", STAGING)


def test_pipeline(spark, saved, loaded, staging):
    for name in STAGING:
        assert rows_of(loaded[name]) == rows_of(staging[name]), name
    assert set(STAGING) <= set(T.list_tables(spark, "staging"))
    assert set(saved) <= set(T.list_tables(spark, "warehouse"))
    star = T.saved_tables(spark, "warehouse", WAREHOUSE)
    for name, report in pipeline.constraint_reports(loaded, star).items():
        numbers = [v for row in report.collect() for c, v in row.asDict().items()
                   if c.endswith(("rows", "keys"))]
        assert set(numbers) == {0}, name
    counts = pipeline.written_counts(spark)
    for name, report in pipeline.constraint_reports(loaded, star, counts).items():
        if name in pipeline.CONSTRAINT_REPORTS:
            assert rows_of(report) == rows_of(pipeline.CONSTRAINT_REPORTS[name]({**loaded, **star})), name
        if name not in ("pk_violations", "fk_violations"):
            assert "Scan parquet" not in report._jdf.queryExecution().toString()
    assert rows_of(spark.table("warehouse.check_load_report")) == rows_of(T.load_report({**loaded, **star}))
    assert check_integrity(loaded)["customers_without_orders"].first()[0] == 15
    report = {r.table_name: r.rows_loaded for r in T.load_report(star).collect()}
    assert report["fact_sales"] == 5949 and report["dim_customer"] == 1500


def test_rebuild_in_order_has_the_same_rows(spark, saved, loaded):
    before = rows_of(saved["fact_sales"].drop("sales_sk"))
    again = pipeline.build_warehouse(spark, loaded, FIRST_DAY, LAST_DAY, ordered=True)["fact_sales"]
    assert rows_of(again.drop("sales_sk")) == before
    assert again.agg({"sales_sk": "max"}).first()[0] == 5949


def test_bucketed_tables_join_without_a_shuffle(spark, csv_folder, saved, loaded):
    from mercaloom.plans.fact import sales_lines
    from mercaloom.sources.csv_files import FILE_PATTERNS

    spark.sql("CREATE DATABASE IF NOT EXISTS dealt")
    tables = dict(loaded)
    for name in T.BUCKET_KEYS:
        for buckets in (3, 4, 4):  # another number makes a new table
            tables[name] = T.load_table(spark, name, csv_folder, pattern=FILE_PATTERNS[name], database="dealt", buckets=buckets)
        assert rows_of(tables[name]) == rows_of(loaded[name])
        assert T.counts_of(spark, "dealt", name)["rows"] == loaded[name].count()
        assert len(T._contents(spark, T._new_folder(spark, "dealt", name))) == 1
    assert T.list_tables(spark, "dealt") == sorted(T.BUCKET_KEYS)
    dims = {n: saved[n] for n in ("dim_customer", "dim_seller", "dim_product")}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled, dealt = (sales_lines(t, dims) for t in (loaded, tables))
        assert rows_of(shuffled) == rows_of(dealt)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (shuffled, dealt)]
        assert ["Exchange hashpartitioning(order_id" in p for p in plans] == [True, False]
        assert plans[1].count("SortMergeJoin") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    T.load_table(spark, "orders", csv_folder, pattern=FILE_PATTERNS["orders"], database="dealt")
    assert T._bucket_number(spark, "dealt.orders") == 0 and spark.table("dealt.orders").count() == loaded["orders"].count()


def test_command_line_runs_again(spark, csv_folder, saved, capsys, monkeypatch):
    from mercaloom import __main__ as command

    monkeypatch.setattr(command, "build_session", lambda: spark)
    command.main(["load", "--data", csv_folder])
    command.main(["profile", "--tables", "sellers"])
    command.main(["build", "--start", "1995-01-01", "--end", "2002-12-31"])
    command.main(["check"])
    command.main(["kpis"])
    shown = capsys.readouterr().out
    assert "seller_city" in shown and "check_orphan_payments" in shown and "kpi_values" in shown
    assert spark.table("warehouse.check_not_null_violations").count() == 33
    assert spark.table("warehouse.check_length_violations").count() > 20
    assert spark.table("staging.profile_sellers").count() == 4


def test_broken_constraints_stop_the_run(spark, csv_folder, tmp_path, saved):
    """A purchase date that cannot be read has no key; the run stops, or reports and goes on."""
    import shutil

    folder = tmp_path / "csv"
    shutil.copytree(csv_folder, folder)
    for part in folder.glob("*orders_dataset-*.csv"):
        lines = part.read_text().splitlines()
        cells = [line.split(",") for line in lines]
        at = cells[0].index("order_purchase_timestamp")
        for row in cells[1:]:
            row[at] = "31/12/2017"
        part.write_text("\n".join(",".join(row) for row in cells) + "\n")
    days = FIRST_DAY, LAST_DAY
    with pytest.raises(pipeline.ConstraintError, match="not_null"):
        pipeline.run(spark, str(folder), start=days[0], end=days[1])
    nulls = spark.table("warehouse.check_not_null_violations").where("null_rows > 0").collect()
    assert [(r.table_name, r.column_name) for r in nulls] == [("fact_sales", "purchase_date_key")]
    done = pipeline.run(spark, str(folder), start=days[0], end=days[1], on_violation="report")
    assert "kpi_values" in done
    with pytest.raises(ValueError):
        pipeline.run(spark, str(folder), on_violation="ignore")
