"""Language model, classifier, fingerprints, mixing, search and the pipeline against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from mercaloom.llm import byte_cnn, common, impact_topk, lz_fingerprint, ngram_trie, queries, rake_mixing
from mercaloom.llm.elias_fano import EliasFano
from mercaloom.llm.hashing import lower_words
from tests.llm.conftest import ODD_TEXTS

# ------------------------------------------------------------------ op1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=60), st.lists(st.integers(0, 1 << 40), max_size=20))
def test_elias_fano(values, queries_):
    values = np.sort(np.array(values, np.uint64))
    sequence = EliasFano.of(values)
    assert np.array_equal(sequence.decode(), values)
    asked = np.array(queries_ + values.tolist(), np.uint64)
    index, equal = sequence.successor(asked)
    assert index.tolist() == np.searchsorted(values, asked).tolist()
    assert equal.tolist() == np.isin(asked, values).tolist()


def test_elias_fano_over_many_runs():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 22, 70_000).astype(np.uint64))
    asked = np.r_[values[::7], rng.integers(0, 1 << 22, 9000).astype(np.uint64)]
    index, equal = EliasFano.of(values).successor(asked)
    assert np.array_equal(index, np.searchsorted(values, asked)) and np.array_equal(equal, np.isin(asked, values))


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(2).integers(0, 1 << 32, 50_000).astype(np.uint64))
    size = sum(a.nbytes for a in EliasFano.of(values).arrays().values())
    assert size * 8 < 50_000 * (2 + 32 - math.log2(50_000) + 1)


def plain_scores(rows):
    """(n_tokens, n_known, train_tokens, base, score) of each row, by counting."""
    tokens = [[*lower_words(t or ""), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    one, two, three, first, pair = Counter(), Counter(), Counter(), Counter(), Counter()
    for words, out in zip(tokens, held):
        if out:
            continue
        one.update(words)
        line = [0, 0, *words]
        for a, b, c in zip(line, line[1:], line[2:]):
            three[a, b, c] += 1
            pair[a, b] += 1
            two[b, c] += 1
            first[b] += 1
    n, kinds = sum(one.values()), len(one)
    out = []
    for words in tokens:
        base = score = 0.0
        line = [0, 0, *words]
        for a, b, c in zip(line, line[1:], line[2:]):
            p = (one[c] + 0.1) / (n + 0.1 * (kinds + 1))
            base += math.log10(p)
            p = (two[b, c] + ngram_trie.M2 * p) / (first[b] + ngram_trie.M2)
            score += math.log10((three[a, b, c] + ngram_trie.M3 * p) / (pair[a, b] + ngram_trie.M3))
        out.append((len(words), sum(one[w] > 0 for w in words), n, base, score))
    return held, out


def scored(docs):
    rows = ngram_trie.scores(docs, ngram_trie.held_out_tenth(F.col("doc_id"))).collect()
    return sorted(((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) for r in rows))


def test_ngram_scores(documents):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "C", "dd", "é"]) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows += [(200, None), (201, "never seen words stand here"), (7, rows[7][1])]
    held, want = plain_scores(rows)
    found = scored(documents(*rows))
    for row, (i, *values, out) in zip(sorted((str(i), *w, h) for (i, _), w, h in zip(rows, want, held)), found):
        assert row[:4] == (i, *values[:3]) and row[-1] == out
        assert values[3:] == pytest.approx(row[4:6], rel=2e-3, abs=2e-3)


def test_ngram_shards_change_counts_of_nothing(documents, monkeypatch):
    monkeypatch.setattr(ngram_trie, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ngram_trie, "SHARD_WORDS", 5)
    monkeypatch.setattr(ngram_trie, "SHARD_TRIGRAMS", 1000)
    rng = random.Random(4)
    rows = [(i, " ".join("w%d" % min(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(40))) for i in range(50)]
    _, want = plain_scores(rows)
    found = scored(documents(*rows))
    assert [f[1:4] for f in found] == [w[:3] for _, w in sorted(zip([str(i) for i, _ in rows], want))]
    assert [f[4] for f in found] == pytest.approx([w[3] for _, w in sorted(zip([str(i) for i, _ in rows], want))])


def test_ngram_scores_are_the_same_for_every_shard_size(documents, monkeypatch):
    monkeypatch.setattr(ngram_trie, "BLOCK_BYTES", 800)
    rng = random.Random(5)
    rows = [(i, " ".join("w%d" % min(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(40))) for i in range(40)]
    rows.append((90, None))
    held, want = plain_scores(rows)
    want = [w[4] for _, w in sorted(zip([str(i) for i, _ in rows], want))]
    for trigrams in (1_000_000, 80):
        monkeypatch.setattr(ngram_trie, "SHARD_TRIGRAMS", trigrams)
        assert [f[5] for f in scored(documents(*rows))] == pytest.approx(want, rel=2e-3, abs=2e-3)


def test_a_model_sums_to_one(documents, monkeypatch):
    """All continuations of a context, unseen ones included, share a probability of 1."""
    context, before = np.array([5, 5, 5, 6], np.uint64), np.array([2, 2, 3, 5], np.uint64)
    word, count = np.array([7, 8, 7, 9], np.uint64), np.array([3, 1, 2, 5])
    levels = ngram_trie.build(context, before, word, count)
    unigram = np.array([0.1, 0.2, 0.3, 0.25, 0.15])
    for b, a in ((5, 2), (5, 3), (5, 99), (6, 5), (77, 2)):
        n = len(unigram)
        part, rest = ngram_trie.look_up(levels, np.full(n, b, np.uint64), np.full(n, a, np.uint64), np.arange(7, 7 + n, dtype=np.uint64))
        assert (part + rest * unigram).sum() == pytest.approx(1, abs=1e-3)


def test_ngram_scores_of_odd_texts(odd, documents):
    found = scored(odd.withColumn("held", F.lit("x")))
    assert len(found) == len(ODD_TEXTS) and all(f[5] < 0 for f in found)
    assert scored(documents()) == []
    alone = scored(documents((2, None), (44, "a")))  # crc32("44") % 10 is not 0 here or both are held out
    assert [f[1] for f in alone] == [1, 2]


# ------------------------------------------------------------------ op5


def test_fingerprints(documents, monkeypatch):
    rng = random.Random(5)
    rows = [(i * 2, "".join(rng.choice("abc é🙂") for _ in range(rng.randint(0, 300)))) for i in range(40)]
    rows += [(5, None), (7, ""), (9, "aaaaaaaaaa"), (-4, rows[3][1]), (6, rows[3][1])]
    rows = list({i: (i, t) for i, t in rows}.values())
    found = {r.doc_id: r for r in lz_fingerprint.fingerprints(documents(*rows)).collect()}
    ordered = sorted(rows, reverse=True)
    for (i, text), (_, next_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, next_ = text or "", next_ or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + next_[:half]
        own, of_edited, of_next = (lz_fingerprint.Parsed(t).signature for t in (text, edited, next_))
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (lz_fingerprint.shown(own), lz_fingerprint.shown(of_edited))
        assert (r.near_edited, r.near_next) == (lz_fingerprint.likeness(own, of_edited), lz_fingerprint.likeness(own, of_next))
    assert len(found) == len(rows)


def test_likeness_follows_the_phrase_sets():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = " ".join(rng.choice(words) for _ in range(3000))
    errors = []
    for cut in (0, 1000, 5000, 9000, 15_000):
        other = text[:cut] + " ".join(rng.choice(words) for _ in range(2000))
        sets = []
        for t in (text, other):
            known = set()
            lz_fingerprint.phrase_ends(t, known)
            sets.append(known)
        exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        errors.append(lz_fingerprint.likeness(*(lz_fingerprint.Parsed(t).signature for t in (text, other))) - exact)
    assert max(map(abs, errors)) < 0.15


def test_fingerprints_of_odd_texts(odd, documents):
    found = lz_fingerprint.fingerprints(odd.withColumn("copy", F.lit(1))).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in ODD_TEXTS)
    of = {r.doc_id: r for r in found}
    assert of[7].fingerprint == of[8].fingerprint and of[8].near_next == 1 and of[2].near_next == 1
    alone = lz_fingerprint.fingerprints(documents((3, "abab"))).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert lz_fingerprint.fingerprints(documents()).count() == 0


# ------------------------------------------------------------------ op7


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.001"
    found = byte_cnn.op7_byte_cnn(spark, folder).join(common.read_table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    right = held.where("lang = lang_pred").count()
    assert right >= 0.95 * held.count() > 20
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_texts(odd, documents):
    learn = documents(*((i, t, lang, "s") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)))
    model = byte_cnn.train(learn)
    assert model.languages == ["de", "en"]
    found = byte_cnn.identify(odd.withColumn("score", F.lit("mine")), model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(ODD_TEXTS) and by_id[1].lang_pred == by_id[2].lang_pred == by_id[3].lang_pred == "und"
    assert by_id[1].score == 0 and by_id[10].lang_pred in ("de", "en") and 0 < by_id[10].score <= 1
    assert byte_cnn.train(odd) is None
    assert {r.lang_pred for r in byte_cnn.identify(odd, None).collect()} == {"und"}
    assert byte_cnn.identify(documents(), model).count() == 0


def test_every_labelled_row_is_learned(documents, monkeypatch):
    """Rows beyond the first 800 of a language change the model, and shards and rounds learn as one task does."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(("der die und", "the and of")[i % 2].split(), k=60)), "de" if i % 2 == 0 else "en") for i in range(1700)]
    first = documents(*rows)
    late = {r.doc_id for r in first.where("lang = 'de'").orderBy(F.xxhash64("doc_id")).offset(800).collect()}
    assert len(late) == 50
    changed = documents(*((i, "zzz " * 60 if i in late else text, lang) for i, text, lang in rows))
    one, other = byte_cnn.train(first), byte_cnn.train(changed)
    assert not np.allclose(one.taps[0], other.taps[0])
    monkeypatch.setattr(byte_cnn, "SHARD", 300)
    for model in (byte_cnn.train(first), byte_cnn.train(first.repartition(7))):
        found = byte_cnn.identify(first, model).where("lang = lang_pred").count()
        assert found == len(rows) and 0 < model.floor <= 1
    assert len({len(w) for w in byte_cnn.spread_windows(b"x" * 5000)}) == 1


def test_runs_hold_the_windows_of_their_text():
    for n in (0, 1, 255, 256, 257, 2047, 2048, 2049, 2305, 5000, 70_000):
        data = bytes(np.random.default_rng(n).integers(0, 256, n, np.uint8))
        runs = byte_cnn.window_runs(data)
        windows = [byte_cnn.spread_windows(run) for run in runs]
        assert sum(map(len, windows)) == len(byte_cnn.spread_windows(data))
        assert sum(map(len, runs)) < n + byte_cnn.WINDOW * (len(runs) + 1) and max(map(len, windows)) <= byte_cnn.RUN
        covered, at = np.zeros(n, bool), 0
        for run in runs:
            at = data.index(run, at)
            covered[at : at + len(run)] = True
        assert covered.all()
        for run, own in zip(runs, windows):  # each byte of a run lies in one of its windows
            starts = np.linspace(0, max(0, len(run) - byte_cnn.WINDOW), len(own)).astype(int)
            assert (np.diff(starts) <= byte_cnn.WINDOW).all() and [run[s : s + byte_cnn.WINDOW] for s in starts] == own


def test_windows_travel_in_runs(documents):
    text = "ein langer Text in einer Sprache " * 300
    rows = byte_cnn.labelled_windows(documents((1, text, "de", "s"), (2, "kurz", "de", "s")), {"de": 2}).collect()
    assert len(rows) == 2 * (1 + -(-len(byte_cnn.spread_windows(text.encode())) // byte_cnn.RUN))


def test_runs_travel_packed(documents):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("der die und ein Haus Baum läuft schnell".split(), k=400)), "kurz", "x" * 9000]
    labelled = documents(*((i, t, "de", "s") for i, t in enumerate(texts)))
    rows = byte_cnn.labelled_windows(labelled, {"de": 1})
    runs = [run for t in texts for run in byte_cnn.window_runs(t.encode())]
    assert sorted(byte_cnn.runs_of(pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()]))) == sorted(runs)
    assert rows.agg(F.sum(F.length("part"))).first()[0] < 0.6 * sum(map(len, runs))


def test_windows_cover_every_byte():
    texts = [b"", b"a", b"x" * 256, b"y" * 257, bytes(range(256)) * 3]
    windows, counts = byte_cnn.windows_of(texts)
    assert counts.tolist() == [1, 1, 1, 2, 3]
    back = [w[w != byte_cnn.PAD].astype(np.uint8).tobytes() for w in windows]
    assert [b"".join(back[a:b]) for a, b in zip(np.cumsum([0, *counts]), np.cumsum(counts))] == texts


def test_tables_answer_as_the_taps():
    rng = np.random.default_rng(8)
    windows = rng.integers(97, 123, (6, byte_cnn.WINDOW)).astype(np.uint16)
    model = byte_cnn.fit(windows, np.array([0, 0, 0, 1, 1, 1]), ["a", "b"])
    x = np.pad(windows.astype(int), ((0, 0), (0, 3)), constant_values=byte_cnn.PAD)
    pooled = np.concatenate(
        [sum(t[k][x[:, k : k + byte_cnn.WINDOW]] for k in range(len(t))).max(1) for t in model.taps], 1
    )
    want = byte_cnn._softmax(np.maximum(pooled + model.bias, 0) @ model.dense + model.offset)
    assert np.allclose(model.probabilities(windows, model.tables()), want, atol=1e-4)


# ------------------------------------------------------------------ op9


def test_raking_meets_the_targets(documents):
    rng = random.Random(9)
    rows = [(i, "word " * rng.randint(1, 60), rng.choice(["en", "en", "de"]), rng.choice("aaabc")) for i in range(600)]
    topic = F.when(F.col("doc_id") % 3 == 0, "x").otherwise("y")
    targets = {"source": {"a": 0.4, "b": 0.3, "c": 0.3}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"x": 0.2, "y": 0.8}}
    docs = documents(*rows)
    _, cells = rake_mixing.with_cells(docs, topic)
    found = {(r._source, r._lang, r._topic): (r.tokens, r.weight) for r in rake_mixing.fitted(cells, targets).collect()}
    # numpy: the same rounds on an array
    names = [sorted(targets[k]) for k in ("source", "lang", "topic")]
    tokens = np.zeros([len(n) for n in names])
    for i, text, lang, source in rows:
        at = names[0].index(source), names[1].index(lang), names[2].index("x" if i % 3 == 0 else "y")
        tokens[at] += len(text.split())
    w = tokens / tokens.sum()
    for _ in range(rake_mixing.ROUNDS):
        for axis, k in enumerate(("source", "lang", "topic")):
            goal = np.array([targets[k][n] for n in names[axis]])
            have = w.sum(tuple(a for a in range(3) if a != axis))
            w = w * (goal / have).reshape([-1 if a == axis else 1 for a in range(3)])
    for at in np.ndindex(w.shape):
        assert found[tuple(n[i] for n, i in zip(names, at))] == (tokens[at], pytest.approx(w[at]))
    rated = {(r._source, r._lang, r._topic): r.rate for r in rake_mixing.rates(rake_mixing.fitted(cells, targets), 0.6).collect()}
    expected = sum(rated[k] * t for k, (t, _) in found.items())
    assert expected == pytest.approx(0.6 * tokens.sum()) and max(rated.values()) <= 1
    open_ = {k: rated[k] * found[k][0] / found[k][1] for k in rated if rated[k] < 1}
    assert max(open_.values()) == pytest.approx(min(open_.values()))  # one scale for all cells that are not full


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_mixing_knows_every_source(documents, monkeypatch, broadcast):
    """230 sources and 60 languages have margins of their own, and a small source finds its target."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    topic = F.lit("t")
    rows = [(i, "a b c d " * (40 if i % 230 < 205 else 1), "l%d" % (i % 60), "s%03d" % (i % 230)) for i in range(690)]
    docs = documents(*rows)
    _, cells = rake_mixing.with_cells(docs, topic)
    share = cells.groupBy("_source").agg(F.sum("tokens").alias("n")).collect()
    assert len(share) == 230 and cells.select("_lang").distinct().count() == 60
    powers = {r._source: r.n**rake_mixing.POWER for r in share}
    one_lang = rake_mixing.with_cells(docs.withColumn("lang", F.lit("en")), topic)[1]
    found = {r._source: r.weight for r in rake_mixing.fitted(one_lang).collect()}
    assert found == pytest.approx({k: v / sum(powers.values()) for k, v in powers.items()})
    targets = {"source": {"s%03d" % i: 1.0 for i in range(230)}}
    kept = rake_mixing.mix(docs, targets, topic=topic).where("source = 's229'").collect()
    assert len(kept) == 3 and all(r.rate > 0 for r in kept)


def test_mixing_keeps_by_rate(documents):
    docs = documents(*((i, "a b c " * (1 + i % 9), "en", "ab"[i % 5 == 0]) for i in range(3000)))
    found = rake_mixing.mix(docs).collect()
    assert len(found) == 3000
    for source in "ab":
        own = [r for r in found if r.source == source]
        assert sum(r.kept for r in own) / len(own) == pytest.approx(sum(r.rate for r in own) / len(own), abs=0.05)
    again = {r.doc_id: r.kept for r in rake_mixing.mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.kept for r in found}


def test_mixing_of_odd_texts(odd, documents):
    docs = odd.withColumn("topic", F.lit("mine")).withColumn("_rate", F.lit(1)).withColumn("tokens", F.lit("t"))
    found = rake_mixing.mix(docs, prefix="p_").collect()
    assert len(found) == len(ODD_TEXTS) and {r.topic for r in found} == {"mine"}
    words = {r.doc_id: r.p_n_tokens for r in found}
    assert words[1] == words[2] == words[3] == 0 and words[10] == 30_000 and words[5] == 2 and words[12] == 3
    assert rake_mixing.mix(documents()).count() == 0


# ------------------------------------------------------------------ op10


def vectors(spark, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return spark.createDataFrame(rows, schema)


def plain_top_k(rows, top=20):
    points = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in points:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in points if i != q and len(w) == len(v))[:top]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(impact_topk, "BLOCK_ROWS", 300)
    monkeypatch.setattr(impact_topk, "QUERY_ROWS", 20)
    rng = np.random.default_rng(12)
    centres = rng.normal(0, 0.2, (9, 12))
    rows = [(i, np.float32(centres[i % 9] + rng.normal(0, 0.05, 12)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)] + [(2000, None), (2020, []), (2040, [1.0, None]), (2060, [float("nan")] * 12), (2080, [0.5, -0.5])]
    rows += [(2100, [0.0] * 12), (2120, [float("inf")] * 12)]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in impact_topk.top_k(vectors(spark, rows)).collect())
    assert found == plain_top_k(rows)
    assert impact_topk.top_k(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in impact_topk.top_k(vectors(spark, [(0, [1.0]), (3, [-1.0])])).collect()] == [(0, 1, 3, -4096)]


@pytest.mark.parametrize("size", [1e3, 1e5, 1e6, 1e7])
def test_top_k_of_large_parts(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, np.float32(rng.uniform(-size, size, 8)).tolist()) for i in range(400)]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in impact_topk.top_k(vectors(spark, rows)).collect())
    assert found == plain_top_k(rows)


def test_top_k_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(impact_topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(impact_topk, "FEW_QUERIES", 4)
    rng = np.random.default_rng(16)
    rows = [(i, np.float32(rng.normal(0, 0.2, 10 + i % 2)).tolist()) for i in range(500)]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in impact_topk.top_k(vectors(spark, rows)).collect())
    assert found == plain_top_k(rows)


def test_top_k_refuses_scores_beyond_64_bits(spark):
    with pytest.raises(Exception, match="64 bits"):
        impact_topk.top_k(vectors(spark, [(0, [1e9] * 8), (1, [1e9] * 8)])).collect()


def test_top_k_of_repeated_and_null_ids(spark):
    rows = [(0, [1.0, 0.0])] * 2 + [(i, [i / 64, 0.0]) for i in range(1, 15)] + [(None, [9.0, 0.0]), (20, [0.0, 1.0])]
    table = vectors(spark, rows).withColumn("row", F.lit(1)).withColumn("block", F.lit("x")).withColumn("dim", F.lit(7))
    found = impact_topk.top_k(table, top=5).collect()
    own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == 0)
    want = [(1, 0, 4096), (2, 14, 14 * 64), (3, 13, 13 * 64), (4, 12, 12 * 64), (5, 11, 11 * 64)]
    assert own == sorted(want * 2)
    assert [(r.rank, r.vec_id) for r in sorted(found, key=lambda r: r.rank) if r.query_id == 20] == [(1, 0), (2, 0), (3, 1), (4, 2), (5, 3)]


def test_search_stops_early_and_is_exact():
    rng = np.random.default_rng(13)
    centres = rng.normal(0, 12, (40, 32))
    data = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 1, (4000, 32))).astype(np.int64)
    block = impact_topk.Block(np.arange(4000), data)
    for q in range(0, 4000, 160):
        ids, scores = block.search(q, data[q])
        exact = data @ data[q]
        order = np.lexsort((np.arange(4000), -exact))
        order = order[order != q][:20]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()


@pytest.mark.parametrize(("shift", "part"), [(0, 0.75), (25, 1)])
def test_search_reads_a_part_of_the_lists_of_vectors_without_order(shift, part):
    """Of spread vectors, too, most rows leave before their postings are taken."""

    class Counted(np.ndarray):
        taken = 0

        def __getitem__(self, key):
            out = np.asarray(super().__getitem__(key))
            Counted.taken += out.size if out.ndim else 0
            return out

    rng = np.random.default_rng(14)
    data = np.floor(rng.normal(shift, 8, (6000, 64))).astype(np.int64)
    block = impact_topk.Block(np.arange(6000), data)
    block.order, block.columns = block.order.view(Counted), block.columns.view(Counted)
    asked = range(0, 6000, 300)
    for q in asked:
        ids, scores = block.search(q, data[q])
        exact = data @ data[q]
        order = np.lexsort((np.arange(6000), -exact))
        order = order[order != q][:20]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert 0 < Counted.taken < part * data.size * len(asked)


def test_search_of_lists_of_all_kinds():
    rng = np.random.default_rng(15)
    far = rng.integers(-3, 4, (500, 6)) * np.array([1, 1, 1, 10**8, 0, 7])  # one list far wider than the others
    near = np.ones((300, 6), np.int64) * 1000 + rng.integers(0, 2, (300, 6))
    for data in (far, near, np.zeros((60, 3), np.int64), np.full((1, 2), 5), np.r_[near, near, near]):
        block = impact_topk.Block(np.arange(len(data))[::-1].copy(), data)
        for q in (*data[:7], -data[0], data[0] * 0, np.eye(data.shape[1], dtype=np.int64)[0]):
            exact = data @ q
            order = np.lexsort((block.ids, -exact))
            order = order[block.rows[order] != 3][:20]
            ids, scores = block.search(3, q)
            assert ids.tolist() == block.ids[order].tolist() and scores.tolist() == exact[order].tolist()


# ------------------------------------------------------------------ queries and pipeline


def test_oracle_sql(spark, small):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    for name, sql in queries.expected_sql().items():
        found = queries.queries()[name](spark, small)
        columns = sorted(found.columns)
        want = sorted(duck.execute(f"select {', '.join(columns)} from ({sql})").fetchall())
        assert sorted(tuple(r) for r in found.select(*columns).collect()) == want, name


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def near_duplicate_groups(docs, width=5, percent=80):
    """Groups of linked texts, all pairs compared; texts without words are alone."""
    sets = []
    for r in docs.select("text").collect():
        words = (r.text or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and group[i] != group[j] and 100 * len(a & b) >= percent * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    return len(set(group))


def test_every_label_is_learned(documents):
    """Eighty languages, of letters of their own, are all predicted."""
    rng = random.Random(4)
    letters = ["".join(map(chr, range(0x4E00 + 40 * i, 0x4E00 + 40 * i + 12))) for i in range(80)]
    text = lambda i: " ".join("".join(rng.choices(letters[i], k=5)) for _ in range(30))
    docs = documents(*((i, text(i % 80), "l%02d" % (i % 80)) for i in range(960)))
    model = byte_cnn.train(docs.where("doc_id < 640"))
    assert len(model.languages) == 80 and 0 < model.floor <= 1
    found = byte_cnn.identify(docs.where("doc_id >= 640"), model).select("lang", "lang_pred", "score").collect()
    assert {r.lang_pred for r in found} == set(model.languages)
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(r.score >= min(0.4, model.floor) for r in found if r.lang == r.lang_pred)


def test_stages(spark, small):
    """Every stage returns its input's columns and keeps what it should."""
    docs = common.read_table(spark, small, "documents")
    extra = docs.withColumn("topic", F.lit("mine")).withColumn("score", F.lit(1))
    clashing = ("_lang_pred", "_lang_score", "_n_lines", "_n_removed", "_mix_kept", "_stays", "_input_5", "odd name.")
    extra = extra.withColumns({name: F.lit(name) for name in clashing})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.store(stage(spark, extra, small), "test-stage")
        assert kept.schema.names == extra.schema.names and 0 < kept.count() <= extra.count()
        assert kept.join(extra, "doc_id", "left_anti").count() == 0, name
        assert [tuple(r) for r in kept.select(*(f"`{c}`" for c in clashing)).distinct().collect()] == [clashing], name
        if name == "language ID":
            assert kept.where(F.col("lang").isNotNull()).count() >= 0.99 * docs.count()
        if name == "n-gram Jaccard join":
            assert kept.count() == near_duplicate_groups(extra) and near_duplicate_groups(kept) == kept.count()
        if name != "mixing":
            extra = kept
    assert corpus_pipeline.STAGES[-1][1](spark, extra, small).count() > 0


def test_stages_on_odd_texts(spark, odd, documents):
    for docs in (odd, documents()):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").count()
