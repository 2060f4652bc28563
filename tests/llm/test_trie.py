"""The prefix trie against plain prefixes and against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercaloom.llm import common, prefix_trie
from mercaloom.operators import skew

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(said.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, totals = defaultdict(int), {}
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path in sorted(members, key=len, reverse=True):
        n, size = len(members[path]), len(path[-1][1].encode()) if path else 0
        leaves, saved = totals.get(path, (0, 0))
        totals[path] = leaves or 1, saved + (n - 1) * size
        if path:
            up = totals.get(path[:-1], (0, 0))
            totals[path[:-1]] = up[0] + totals[path][0], up[1] + totals[path][1]
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == path)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), children[path], *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def grown(n, seed=5):
    """Conversations that share starts of many lengths, with rows out of order, copies, nulls and ties."""
    draw = random.Random(seed)
    rows, starts = [], [[]]
    for c in range(n):
        turns = list(draw.choice(starts))
        turns += [(draw.choice(["user", "assistant", None]), draw.choice(["a", "é", "", None, "long text"])) for _ in range(draw.randrange(5))]
        starts.append(turns)
        rows += [(c * 3 % (n + 7), i if i else None, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(5, 1, "user", "tie"), (5, 1, "assistant", "tie"), (5, 1, "user", "tie"), (None, 1, "user", "nobody"), (10**12, None, None, None)]
    draw.shuffle(rows)
    return rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=60), st.integers(2, 9))
def test_queue_gives_back_all_in_order(keys, limit):
    queue = prefix_trie.SpillingQueue(limit)
    items = [(*key, i, -i, 7) for i, key in enumerate(keys)]
    for item in items:
        queue.push(item)
        assert len(queue.heap) <= limit
    for key in sorted(set(keys)):
        assert list(queue.pop_up_to(key)) == sorted(x for x in items if x[:2] == key)
    assert list(queue.pop_up_to((9, 9))) == []


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_is_that_of_all_prefixes(spark, shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "QUEUE_ITEMS", 3)
    rows = grown(60)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.prefix_trie(table, shards)) == plain(rows)


def test_conversations_longer_than_a_shard(spark, monkeypatch):
    """One conversation through many shards, numbered as a hot key and scanned in many blocks, others branching off it."""
    monkeypatch.setattr(prefix_trie, "SCAN_ROWS", 16)
    monkeypatch.setattr(prefix_trie, "find_hot_keys", lambda df, *c: skew.find_hot_keys(df, *c, min_rows=50))
    rows = [(0, i, "user", f"t{i}") for i in range(400)] + [(1, i, "user", f"t{i}") for i in range(200)]
    rows += [(c, i, "user", f"t{i}" if i < c else f"{c}") for c in range(2, 150, 7) for i in range(c + 2)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.prefix_trie(table, 23)) == plain(rows)


def test_no_rows_and_odd_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(empty).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    rows = [(1, 1, "user", None), (1, 1, "user", None), (6, None, None, ""), (7, 2, "user", "x" * 300_000), (-4, 0, "", "y")]
    table = spark.createDataFrame([r + (1, "n", "s") for r in rows], SCHEMA + ", depth int, node string, shard string")
    assert [r[:5] for r in found(prefix_trie.prefix_trie(table))] == [r[:5] for r in plain_negative(rows)]


def plain_negative(rows):
    """Only families of ids of 0 and more are told alike by Python and by Spark; here no family has a first."""
    assert all(c - c % 5 not in {r[0] for r in rows} for c, *_ in rows)
    return plain(rows)


def test_query_and_sql(spark, small, tmp_path):
    from mercaloom.llm.queries import expected_sql, queries

    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{small}/conversations.parquet'")
    want = con.sql(expected_sql()["op12_prefix_trie"]).df()
    df = queries()["op12_prefix_trie"](spark, small)
    assert found(df) == sorted(map(tuple, want[list(COLUMNS)].astype(object).where(want.notna(), None).values.tolist()), key=str)
    rows = [tuple(r) for r in common.read_table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(df) == plain(rows)
    con.sql("create or replace view conversations as select * from (values " + ",".join(
        "(" + ",".join("null" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in grown(40, 8)
    ) + ") t(conv_id, turn, role, text)")
    got = con.sql(expected_sql()["op12_prefix_trie"])
    assert sorted((tuple(dict(zip(got.columns, r))[c] for c in COLUMNS) for r in got.fetchall()), key=str) == plain(grown(40, 8))
