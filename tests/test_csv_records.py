"""Records of CSV files that are read in many splits, against one task and against plain reading."""

import random
from contextlib import contextmanager

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercaloom.sources import csv_records
from mercaloom.sources import tables as T
from mercaloom.sources.csv_files import accepted, read_table, rejected

SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
NAMES = SELLERS.strip().split(",")
REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
)


@contextmanager
def split_bytes(spark, size):
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, size)
    try:
        yield
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


def plain_state(line, inside):
    """The state after a line, character by character."""
    at, fresh = 0, True
    while at < len(line):
        c = line[at]
        if inside:
            if c == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                inside, fresh = False, False
        elif c == ",":
            fresh = True
        elif c == '"' and fresh:
            inside = True
        else:
            fresh = False
        at += 1
    return inside


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet='ab,"', max_size=25), st.booleans())
def test_state_after_a_line(line, inside):
    assert csv_records.ends_inside(line, inside) == plain_state(line, inside)


def review_file(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = draw.choice(["", "plain", 'said "yes"', "one\ntwo", "a\n\n\nb, c", '"\n"', "x" * 300, "\n".join("abcdefgh"), 'tail"'])
        quoted = '"' + text.replace('"', '""') + '"'
        message = quoted if any(c in text for c in '\n,') or draw.random() < 0.3 else text
        rows.append((f"r{i}", text or None, f'r{i},o{i},{i % 5 + 1},5" pipe,{message},2018-01-18 00:00:00,\n'))
    return REVIEWS + "".join(r[2] for r in rows), {r[0]: r[1] for r in rows}


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_many_splits_equal_one_task(spark, tmp_path, newline):
    text, want = review_file(400)
    (tmp_path / "r.csv").write_bytes(text.replace("\n", newline).encode())
    path = str(tmp_path / "r.csv")
    one = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    with split_bytes(spark, 300):
        found = read_table(spark, "reviews", path)
        assert csv_records.split_starts(spark, path, None, REVIEWS.strip().split(",")).splits.count() > 100
        rows = {r.review_id: r for r in accepted(found).collect()}
        assert rejected(found).count() == 0
    assert len(rows) == one.count() == 400
    messages = {i: r.review_comment_message for i, r in rows.items()}
    assert messages == {r.review_id: r.review_comment_message for r in one.collect()}
    assert {i: (m or "").strip('"') for i, m in messages.items()} == {i: (t or "").strip('"') for i, t in want.items()}
    assert {r.review_comment_title for r in rows.values()} == {'5" pipe'}


def test_loading_in_many_splits(spark, tmp_path):
    text, want = review_file(300, seed=2)
    lines = text.replace("r77,o77,", "r77,,").replace("r200,o200,", 'r200,"o200\n",')  # one order missing, one over two lines
    (tmp_path / "a_reviews.csv").write_text(lines)
    (tmp_path / "b_reviews.csv").write_text(REVIEWS + 'q1,o1,bad,,"x\ny",,\n\n\nq2,o2,3,,,,\n')
    T.create_databases(spark)
    with split_bytes(spark, 500):
        T.load_table(spark, "reviews", str(tmp_path), on_reject="quarantine")
        with pytest.raises(T.LoadError, match="record 78: "):
            T.load_table(spark, "reviews", str(tmp_path))
    assert spark.table("staging.reviews").count() == 300 - 1 + 1
    assert spark.table("staging.reviews").where("review_id = 'r200'").first().order_id == "o200\n"
    bad = {r.number: r for r in spark.table("staging.reviews_rejected").collect()}
    assert {n: (r.file[-13:], r.reasons) for n, r in bad.items()} == {
        78: ("a_reviews.csv", ["order_id: missing"]), 1: ("b_reviews.csv", ["review_score: not int"]),
    }
    assert bad[1].record == 'q1,o1,bad,,"x\ny",,'


def test_a_line_break_in_any_table(spark, tmp_path):
    (tmp_path / "s.csv").write_text(SELLERS + 's1,1,"são\npaulo",SP\ns2,2,"a ""b"", c",RJ\n')
    found = read_table(spark, "sellers", str(tmp_path / "s.csv"))
    assert {r.seller_id: r.seller_city for r in accepted(found).collect()} == {"s1": "são\npaulo", "s2": 'a "b", c'}
    assert rejected(found).count() == 0


def test_number_of_a_bad_row(spark, tmp_path):
    rows = [f"s{i},{i},city {i},SP\n" for i in range(1, 2001)]
    rows[1499] = "s1500,1500,x,TOOLONG\n"
    rows[700] = 's701,"1\n\n1",x,SP\n'  # a record of three lines counts once
    (tmp_path / "s.csv").write_text("﻿" + SELLERS + "".join(rows))
    with split_bytes(spark, 400):
        bad = rejected(read_table(spark, "sellers", str(tmp_path / "s.csv"))).collect()
        assert [(r.number, r.record) for r in bad] == [(1500, "s1500,1500,x,TOOLONG")]
        for changed in ("s701,1,x,SP\n", '"s701",1,"x",SP\n', "\n \ns701,1,x,SP\n"):  # no quotes, closed quotes, blank lines
            rows[700] = changed
            (tmp_path / "s.csv").write_text(SELLERS + "".join(rows))
            starts = csv_records.split_starts(spark, str(tmp_path / "s.csv"), None, NAMES)
            assert starts.lines_are_records == ("\n \n" not in changed)
            found = read_table(spark, "sellers", str(tmp_path / "s.csv"))
            assert [(r.number, r.record) for r in rejected(found).collect()] == [(1500, "s1500,1500,x,TOOLONG")]
            assert accepted(found).count() == 1999


def test_a_quote_that_is_never_closed(spark, tmp_path, monkeypatch):
    text = SELLERS + "s0,0,x,SP\n" + 's1,1,"open,SP\n' + "".join(f"s{i},{i},city,SP\n" for i in range(2, 300))
    (tmp_path / "s.csv").write_text(text)
    for limit in (csv_records.LONGEST_RECORD, 1000):
        monkeypatch.setattr(csv_records, "LONGEST_RECORD", limit)
        with split_bytes(spark, 400):
            found = read_table(spark, "sellers", str(tmp_path / "s.csv"))
            assert [r.seller_id for r in accepted(found).collect()] == ["s0"]
            bad = rejected(found).collect()
        assert len(bad) == 1 and bad[0].number == 2 and bad[0].record.startswith('s1,1,"open,SP')
        assert "malformed record" in bad[0].reasons


def test_files_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(SELLERS + "s1,1,x,SP\n")
    (tmp_path / "b.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns2,x,1,SP\n")
    with pytest.raises(ValueError, match="another header"):
        read_table(spark, "sellers", str(tmp_path))
    (tmp_path / "b.csv").write_text('"seller_id",seller_zip_code_prefix,seller_city,seller_state\ns2,1,x,SP\n')
    assert accepted(read_table(spark, "sellers", str(tmp_path))).count() == 2


def test_changed_splits_are_an_error(spark, tmp_path):
    (tmp_path / "s.csv").write_text(SELLERS + "".join(f"s{i},{i},x,SP\n" for i in range(300)))
    with split_bytes(spark, 400):
        starts = csv_records.split_starts(spark, str(tmp_path), None, NAMES)
    with split_bytes(spark, 900), pytest.raises(Exception, match="changed"):
        csv_records.read_pieces(spark, str(tmp_path), None, starts).agg(F.sum("number")).collect()


def test_no_files_no_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text(SELLERS)
    assert accepted(read_table(spark, "sellers", str(tmp_path))).count() == 0
    T.create_databases(spark)
    assert T.load_table(spark, "sellers", str(tmp_path)).count() == 0
