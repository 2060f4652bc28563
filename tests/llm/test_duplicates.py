"""Suffix dedup, line chunks and the Jaccard join against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mercaloom.llm import common, jaccard_rtree, line_chunks, suffix_dedup
from mercaloom.llm.components import components
from mercaloom.llm.hashing import lower_words
from tests.conftest import rows_of
from tests.llm.conftest import ODD_TEXTS


def near_copies(seed, families=4, copies=9, words=60, rate=0.03):
    """Families of edited copies, among texts of their own, with shared passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") * rng.randint(1, 3)
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(words // 6, words * 3))]
        for _ in range(copies):
            texts.append(" ".join(word() if rng.random() < rate else w for w in base))
    passage = " ".join(word() for _ in range(70))
    texts += [" ".join(word() for _ in range(20)) + " " + passage + " " + " ".join(word() for _ in range(9)) for _ in range(5)]
    texts += ["aaaa " * 90, "ab" * 300, "ab" * 301, "é" * 150 + "q", "é" * 150 + "r", texts[0], texts[0]]
    return [(i * 3, t) for i, t in enumerate(texts)]


# ------------------------------------------------------------------ op2


def removed_by_brute_force(texts):
    data = [(t or "").encode() for _, t in texts]
    span, seen = suffix_dedup.SPAN, {}
    for d in data:
        for s in range(len(d) - span + 1):
            seen[d[s : s + span]] = seen.get(d[s : s + span], 0) + 1
    out = []
    for (doc_id, _), d in zip(texts, data):
        covered = np.zeros(len(d), bool)
        for s in range(len(d) - span + 1):
            if seen[d[s : s + span]] > 1:
                covered[s : s + span] = True
        kept = bytes(b for b, c in zip(d, covered) if not c)
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        out.append((str(doc_id), len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed_by_spark(docs):
    rows = suffix_dedup.removed_runs(docs).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("hot, digest", [(20_000, 8), (2, 8), (2, 1)])  # a digest of one byte makes hashes collide
def test_suffix_dedup(documents, monkeypatch, hot, digest):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "WINDOW_HASH", digest)
    texts = near_copies(1)
    assert removed_by_spark(documents(*texts)) == removed_by_brute_force(texts)


def test_no_group_holds_the_copies_of_a_passage(spark, monkeypatch):
    """One passage in many texts: Python gets no window of it, all copies go."""
    monkeypatch.setattr(suffix_dedup, "HOT", 500)
    passage = "".join(chr(97 + i * i % 23) for i in range(397))
    texts = [(i, hashlib.md5(b"%d" % i).hexdigest() + passage + hashlib.sha256(b"%d" % i).hexdigest()) for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen = []
    original = suffix_dedup.contexts
    monkeypatch.setattr(suffix_dedup, "contexts", lambda *a: seen.append(original(*a)) or seen[-1])
    found = removed_by_spark(docs)
    assert found == removed_by_brute_force(texts) and min(r[2] for r in found) >= 397
    largest = seen[0].groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    assert largest <= 1000


def test_copies_of_a_context_are_spelled_out_once(spark, monkeypatch):
    """Windows of a frequent gram come of distinct contexts, so their number does not grow with the copies."""
    monkeypatch.setattr(suffix_dedup, "HOT", 100)
    passage = "".join(hashlib.sha256(b"%d" % i).hexdigest() for i in range(16))
    texts = [(i, hashlib.md5(b"%d" % i).hexdigest() + passage) for i in range(150)]
    texts.append((150, texts[0][1][:-10] + texts[0][1]))  # a text that repeats itself
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen = []
    original = suffix_dedup.hot_windows
    monkeypatch.setattr(suffix_dedup, "hot_windows", lambda *a: seen.append(original(*a)) or seen[-1])
    assert removed_by_spark(docs) == removed_by_brute_force(texts)
    assert len(passage) - 2 * suffix_dedup.REACH <= seen[0].count() <= len(passage) + len(texts) * suffix_dedup.REACH


def test_suffix_dedup_in_pieces(documents, monkeypatch):
    texts = [(i, t * 3) for i, t in near_copies(2, families=2)]
    assert removed_by_spark(documents(*texts)) == removed_by_brute_force(texts)
    found = suffix_dedup.removed_runs(documents(*texts), with_text=True).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in found)


def test_a_text_in_pieces_has_the_same_anchors(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(97, 100, 5000)))
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])

    def all_anchors():
        out = {}
        for data, ends, _, bases in suffix_dedup.pieces(batch):
            for g, p, a, b in zip(*suffix_dedup.anchors(data, ends)):
                for s in range(a, b + 1):
                    out[s + bases[0]] = (g, p + bases[0])
        return out

    whole = all_anchors()
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    assert all_anchors() == whole and len(whole) == 5000 - suffix_dedup.SPAN + 1


def test_collisions_are_found_and_mended(monkeypatch):
    """With hashes that say that all is equal, the sort falls back on the bytes."""
    rng = random.Random(4)
    parts = [bytes(rng.choice(b"ab") for _ in range(260)) for _ in range(20)]
    parts += parts[:5]
    data = np.frombuffer(b"".join(parts), np.uint8)
    start = np.arange(len(parts)) * 260
    args = (data, start, start + 40, start + 260, np.zeros(len(parts), np.int64))
    want = suffix_dedup.Suffixes(*args).repeated()
    monkeypatch.setattr(suffix_dedup.Hashes, "of", lambda self, s, n: np.zeros(len(s), np.uint64))
    assert np.array_equal(suffix_dedup.Suffixes(*args).repeated(), want) and want[:5].any() and not want[5:20].any()


def test_suffix_dedup_of_odd_texts(odd, documents):
    found = {(str(r.doc_id), r.n_bytes): r for r in suffix_dedup.removed_runs(odd.withColumn("kind", F.lit(1))).collect()}
    assert len(suffix_dedup.removed_runs(odd).collect()) == len(ODD_TEXTS)
    assert found["10", 150_000].n_removed == 150_000 and found["11", 70_000].n_spans == 1
    assert found["1", 0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert suffix_dedup.removed_runs(documents()).count() == 0


# ------------------------------------------------------------------ op4


def deduped_by_brute_force(texts):
    first, split = {}, [(doc_id, (text or "").split("\n")) for doc_id, text in sorted(texts)]
    out = []
    for doc_id, lines in split:
        gone = set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if not "".join(pair).strip(" \t\x0b\f\r"):
                continue
            where, at = first.setdefault(pair, (doc_id, i))
            if where != doc_id or i > at + 1:
                gone |= {i, i + 1}
        out.append((str(doc_id), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out)


def test_line_chunks(documents):
    rng = random.Random(6)
    shared = ["shared line %d" % i for i in range(40)]
    texts = []
    for i in range(40):
        at = rng.randint(0, 20)
        own = ["own %d %d" % (i, k) for k in range(rng.randint(0, 6))]
        texts.append((i, "\n".join(own[:2] + shared[at : at + rng.randint(3, 20)] + own[2:])))
    docs = documents(*texts)
    found = line_chunks.dedup_lines(docs)
    assert sorted((str(r.doc_id), r.text) for r in found.collect()) == deduped_by_brute_force(texts)
    assert found.agg(F.sum("n_removed")).first()[0] > 100


@pytest.mark.parametrize("most, lines", [(64, 4), (2, 1), (3, 1 << 40)])
def test_line_chunks_beyond_the_broadcast(documents, monkeypatch, most, lines):
    """Neither the join nor where chunks are cut changes what goes."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(line_chunks, "MOST_PAIRS", most)
    monkeypatch.setattr(line_chunks, "LINES_PER_CHUNK", lines)
    texts = [(i, "a\nb\nc\nd\ne\nf\ng\nh\n%d" % (i % 3)) for i in range(12)]
    found = line_chunks.dedup_lines(documents(*texts)).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == deduped_by_brute_force(texts)


def test_line_chunks_of_odd_texts(odd, documents):
    clash = odd.withColumn("n_lines", F.lit("x")).withColumn("_row", F.lit(1)).withColumn("_chunks", F.lit(1)).withColumn("odd name.", F.lit(2))
    found = line_chunks.dedup_lines(clash)
    assert set(found.columns) == {*clash.columns, "n_removed"} and found.count() == len(ODD_TEXTS)
    rows = {(r.doc_id, r.text) for r in found.collect()}
    assert (1, "") in rows and (7, ODD_TEXTS[6][1]) in rows and (8, "") in rows
    assert line_chunks.dedup_lines(documents()).count() == 0


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_passages_go_whole(spark, documents, monkeypatch, broadcast):
    """Planted passages of 2 to 6 lines and over 50 words stay once, whatever stands around them."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rng = random.Random(16)
    line = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 999)) for _ in range(n))
    passages = [[line(52 // n + 1) for _ in range(n)] for n in (2, 3, 4, 5, 6)]
    common_line = line(9)
    texts, want = [], []
    for i in range(30):
        passage = passages[i % 5]
        before, after = ([line(8) for _ in range(rng.randint(1, 4))] for _ in range(2))
        before.insert(0, common_line)  # a repeated line alone is no passage
        texts.append((i, "\n".join(before + passage + after)))
        want.append((i, "\n".join(before + passage * (i < 5) + after)))
    # a run of one line: pairs that overlap the first one stay; a copy goes whole
    texts += [(40, "z\nz\nz\nz"), (41, texts[0][1]), (42, "y\n\n\n\ny"), (43, "x"), (44, None), (40, "z\nz\nz\nz")]
    want += [(40, "z\nz"), (41, ""), (42, "y\n\n\n\ny"), (43, "x"), (44, ""), (40, "z\nz")]
    found = corpus_pipeline.line_dedup(spark, documents(*texts), "").collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in found)


# ------------------------------------------------------------------ op6


def shingles(text):
    w = lower_words(text or "")
    return {tuple(w)} if 0 < len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def components_by_brute_force(texts):
    sets = [shingles(t) for _, t in texts]
    label = [i for i, _ in texts]
    changed = True
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((str(i), len(s), str(c)) for (i, _), s, c in zip(texts, sets, label))


def components_by_spark(docs):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_rtree.linked_components(docs).collect())


@pytest.mark.parametrize("seed, rate", [(7, 0.01), (8, 0.02)])
def test_jaccard_components(documents, seed, rate):
    texts = near_copies(seed, families=6, rate=rate)
    want = components_by_brute_force(texts)
    assert components_by_spark(documents(*texts)) == want
    assert len({c for _, _, c in want}) < len(texts) - 10


def test_near_duplicates_of_the_pipeline(spark, documents):
    """The stage takes five words and 0.8, whatever op6 takes."""
    texts = [(i, t) for i, (_, t) in enumerate(near_copies(12, families=8, words=120, rate=0.012))]
    words = [lower_words(t) for _, t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    label = list(range(len(sets)))
    links = [(a, b) for a in label for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    docs = documents(*texts)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(set(label))
    assert len(kept) < jaccard_rtree.linked_components(docs).select("component_id").distinct().count()


def test_jaccard_of_split_groups(documents, monkeypatch):
    """Groups of meeting classes above PIECE are searched in pairs of pieces."""
    monkeypatch.setattr(jaccard_rtree, "PIECE", 3)
    texts = near_copies(9, families=3, copies=14, rate=0.012)
    assert components_by_spark(documents(*texts)) == components_by_brute_force(texts)


def test_sets_that_can_link_always_meet():
    """The meeting keys against all pairs of random sets at the limit."""
    rng = np.random.default_rng(10)
    for n in (9, 10, 11, 13, 14, 19, 20, 21, 28, 40, 95, 200):
        for _ in range(20):
            base = rng.integers(0, 1 << 63, n).astype(np.uint64)
            other = rng.permutation(base)
            lost = rng.integers(0, n // 10 + 1)
            added = int((n - lost) / 0.9) - n if rng.random() < 0.5 else 0
            other = np.r_[other[lost:], rng.integers(0, 1 << 63, max(0, added)).astype(np.uint64)]
            overlap = n - lost
            if 100 * overlap < 90 * (n + len(other) - overlap):
                continue
            flat = np.r_[np.sort(base), np.sort(other)]
            keys, owner = jaccard_rtree.meeting_keys(flat, np.array([0, n, n + len(other)]))
            assert set(keys[owner == 0]) & set(keys[owner == 1]) or (lost == 0 and added == 0 and n < 9)


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5)])
def test_long_texts_have_few_meeting_keys(percent, width):
    """A set has a key for each shingle in which it can differ from a partner; sets at the limit still meet."""
    rng = np.random.default_rng(14)
    for n in (5003, 6000, 7500, 9999, 20_000):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        lost = n * (100 - percent) // 100
        one, other = np.sort(base), np.sort(base[lost:])
        keys, owner = jaccard_rtree.meeting_keys(np.r_[one, other], np.array([0, n, 2 * n - lost]), percent)
        assert len(keys) <= 2 * (lost + 2) and set(keys[owner == 0]) & set(keys[owner == 1])
    for n in range(percent // (100 - percent), 60):
        for _ in range(20):
            base = rng.integers(0, 1 << 63, n).astype(np.uint64)
            lost = int(rng.integers(0, n * (100 - percent) // 100 + 1))
            added = (n - lost) * 100 // percent - n
            other = np.r_[base[lost:], rng.integers(0, 1 << 63, max(0, added)).astype(np.uint64)]
            flat = np.r_[np.sort(base), np.sort(other)]
            keys, owner = jaccard_rtree.meeting_keys(flat, np.array([0, n, n + len(other)]), percent)
            assert set(keys[owner == 0]) & set(keys[owner == 1])


@pytest.mark.parametrize("seed", range(4))
def test_sets_meet_whatever_order_the_cells_have(seed):
    """Any order of the cells serves, cells that tie included, as long as all sets use the same."""
    rng = np.random.default_rng(seed)
    ranks = rng.integers(0, (3, 100, 60_000, 1)[seed], jaccard_rtree.CELLS)
    for n in rng.integers(9, 400, 60):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        other = base[n // 10 :]
        keys, owner = jaccard_rtree.meeting_keys(np.r_[base, other], np.array([0, n, n + len(other)]), 90, ranks)
        assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_full_counts_bound_nothing():
    """A byte that is full stands for any count, so such sets are never ruled out by it."""
    one, other = np.full((1, jaccard_rtree.GROUPS), 2, np.uint8), np.full((1, jaccard_rtree.GROUPS), 3, np.uint8)
    assert jaccard_rtree.bounds(one, other)[0] == 2 * jaccard_rtree.GROUPS
    one[0, 5] = other[0, 5] = jaccard_rtree.FULL
    assert jaccard_rtree.bounds(one, other)[0] > 1 << 32
    rng = np.random.default_rng(3)
    many = np.unique(rng.integers(0, 1 << 63, 60_000).astype(np.uint64))
    counts = jaccard_rtree.count_vectors(np.r_[many, many[:100]], np.array([0, len(many), len(many) + 100]))
    assert counts[0].max() == jaccard_rtree.FULL and counts[1].sum() == 100


def test_each_candidate_is_named_once(spark, documents):
    """Sets that share many keys come out of one meeting only."""
    texts = near_copies(21, families=2, copies=8, words=200, rate=0.01)
    docs = documents(*texts)
    rows, ranks = jaccard_rtree.class_table(docs)
    scratch = common.Scratch(spark)
    classes = jaccard_rtree._classes(rows, scratch)
    met = jaccard_rtree.met_classes(docs, ranks, 80, 3, scratch)
    found = jaccard_rtree._searched(met.withColumn("part", F.col("class")), classes, jaccard_rtree.first_keys(met, scratch), 80)
    before = found.collect()
    assert len(before) == len(set(before)) > 20 and met.count() > 3 * len(texts)
    scratch.drop()


def test_links_of_classes(documents):
    texts = near_copies(15, families=3, rate=0.008)
    sets = {i: frozenset(shingles(t)) for i, t in texts}
    links, members = jaccard_rtree.class_links(documents(*texts), percent=80)
    class_of = {r.doc_id: r["class"] for r in members.collect()}
    want = {
        (max(class_of[a], class_of[b]), min(class_of[a], class_of[b]))
        for a in sets
        for b in sets
        if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert {(r.a, r.b) for r in links.collect()} == want and len(want) > 10


def test_the_tree_finds_what_brute_force_finds():
    rng = np.random.default_rng(11)
    group = np.sort(rng.integers(0, 3, 400))
    base = rng.integers(0, 8, (12, jaccard_rtree.GROUPS))
    counts = base[rng.integers(0, 12, 400)] + (rng.random((400, jaccard_rtree.GROUPS)) < 0.04)
    size = counts.sum(1)
    order = np.lexsort((size, group))
    group, size, counts = group[order], size[order], counts[order]
    part = rng.integers(0, 5, 400)
    found = {(a, b) for i, j in jaccard_rtree.Tree(group, size, counts, part).pairs(90) for a, b in zip(i.tolist(), j.tolist())}
    want = {
        (a, b)
        for a in range(400)
        for b in range(a)
        if group[a] == group[b] and part[a] != part[b]
        and jaccard_rtree.enough(np.minimum(counts[a], counts[b]).sum(), size[a], size[b])
    }
    assert found == want and len(want) > 100


def test_best_partners():
    """Each point's best pair, over all parts in which the pairs come."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 5, (40, jaccard_rtree.GROUPS)).astype(np.uint8)
    size = counts.sum(1, dtype=np.int64)
    i, j = np.array([(a, b) for a in range(39) for b in range(a) if (a + b) % 3]).T
    parts = [(i[k::4], j[k::4]) for k in range(4)]
    found = jaccard_rtree.best_partners(iter(parts), size, counts)
    share = {}
    for a, b in zip(i.tolist(), j.tolist()):
        share[a, b] = share[b, a] = np.minimum(counts[a], counts[b]).sum(dtype=int) / (size[a] + size[b])
    for a in range(39):
        assert share[a, found[a]] == max(share[a, b] for b in range(39) if (a, b) in share)
    assert found[39] == -1


def test_jaccard_of_odd_texts(odd, documents):
    found = components_by_spark(odd.withColumn("class", F.lit(1)))
    assert len(found) == len(ODD_TEXTS)
    assert ("1", 0, "1") in found and found.count(("8", 11, "7")) == 2 and ("None", 5, "None") in found
    assert components_by_spark(documents()) == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7), (200, 199)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100, 199: 199, 200: 199}


def test_counted_join_bears_hot_keys(spark):
    left = spark.range(4000).select((F.col("id") % 7).alias("row"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"))
    right = left.groupBy("key").agg(F.count("*").alias("n"), F.sum("row").alias("s")).where("key < 3000")
    found = common.join_counted(left, right, "key", "n", 4000)
    want = left.join(right, "key", "left").select("row", "key", "n", "s")
    assert rows_of(found) == rows_of(want)


def test_unmatched_rows_do_not_pass_a_join_for_matches(spark):
    """A hot key and cold ones meet; rows without a partner are not made, so the join's rows follow its matches."""
    left = spark.range(4000).selectExpr("case when id < 3000 then id else 7 end as key", "id % 5 as row")
    right = left.where("key % 10 = 7").groupBy("key").agg(F.count("*").alias("n"))
    found = common.matches_counted(left, right, "key", "n", 4000)
    assert rows_of(found) == rows_of(left.join(right, "key").select("key", "row", "n"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan
    assert common.matches_counted(left, right.where("n = 1"), "key", "n", 4000).count() == 299
