"""The quality classifier: held-out accuracy, trees against a plain descent, and odd rows."""

import zlib

import numpy as np
import pytest

from mercaloom.llm import boosted_quality as quality
from tests.llm.conftest import ODD_TEXTS

LABELS = "doc_id long, quality int, toxic int"


def plain_descent(model, row):
    raw = model.base
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        place = 0
        while place < len(feature):
            place = 2 * place + (2 if row[feature[place]] > threshold[place] else 1)
        raw += leaf[place - len(feature)]
    return 1 / (1 + np.exp(-raw))


def made(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)).astype(np.float32)
    x[:, 4] = np.round(x[:, 4])
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] + x[:, 4] > 0.5)).astype(float)
    return x, y


def test_trees_are_descended_as_a_plain_loop_does():
    x, y = made()
    model = quality.fit(x, y, np.ones(len(y)))
    assert np.allclose(model.probabilities(x), [plain_descent(model, row) for row in x])
    assert model.feature.shape == (len(model.leaf), 2**quality.DEPTH - 1) and len(model.leaf) > 5
    test_x, test_y = made(seed=4)
    assert ((model.probabilities(test_x) >= 0.5) == test_y).mean() > 0.85


def test_first_split_is_the_best_one():
    """All cuts of all statistics tried one by one give no larger gain than the histogram's."""
    x, y = made(200)
    p, cuts = np.full(len(y), y.mean()), [np.unique(c).astype(np.float32) for c in np.round(x).T]
    codes = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, np.round(x).T)], 1)
    g, h = p - y, p * (1 - p)
    padded = [np.r_[c, np.full(quality.BINS - len(c), np.inf, np.float32)] for c in cuts]
    feature, threshold, *_ = quality._tree(codes, padded, g, h)

    def gain(column, cut):
        left = np.round(x[:, column]) <= cut
        parts = [(g[m].sum() ** 2 / (h[m].sum() + quality.SHRINK), h[m].sum()) for m in (left, ~left)]
        return sum(v for v, _ in parts) if min(w for _, w in parts) >= quality.LEAST_WEIGHT else 0

    tried = {(c, float(cut)): gain(c, cut) for c in range(5) for cut in cuts[c]}
    assert gain(feature[0], threshold[0]) == pytest.approx(max(tried.values()))


def test_weights_stand_for_rows():
    x, y = made(300)
    a = quality.fit(x, y, np.where(y > 0, 3.0, 1.0))
    assert a.base == pytest.approx(np.log(3 * y.sum() / (len(y) - y.sum())))


def test_without_both_classes_every_score_is_the_share():
    x = np.zeros((4, len(quality.FEATURES)), np.float32)
    for y, want in ((np.zeros(0), 0.5), (np.ones(4), 1.0), (np.zeros(4), 0.0)):
        model = quality.fit(x[: len(y)], y, np.ones(len(y)))
        assert model.probabilities(x) == pytest.approx(np.full(4, want), abs=1e-5)
        assert ((model.probabilities(x) >= 0) & (model.probabilities(x) <= 1)).all()


def test_statistics_of_odd_texts():
    texts = [t or "" for _, t in ODD_TEXTS]
    x = quality.statistics(texts)
    assert x.shape == (len(texts), len(quality.FEATURES)) and np.isfinite(x).all()
    alone = np.concatenate([quality.statistics([t]) for t in texts])
    assert np.array_equal(x, alone)
    named = dict(zip(quality.FEATURES, quality.statistics(["AB ab ab\nab"])[0]))
    assert named["upper"] == pytest.approx(2 / 11) and named["distinct words"] == pytest.approx(0.5)
    assert quality.statistics([]).shape == (0, len(quality.FEATURES))


def test_odd_rows_and_labels(spark, odd, documents):
    odd = odd.withColumn("score", odd["text"]).withColumn("statistics", odd["doc_id"]).withColumn("place", odd["text"])
    labels = spark.createDataFrame(
        [(4, 1, 0), (4, 1, 1), (5, 1, 0), (5, 0, 0), (6, None, 0), (7, 7, 0), (8, 0, 0), (None, 1, 0), (99, 1, 0)], LABELS
    )
    x, y, weight = quality.training_sample(odd, labels)
    assert sorted(y.tolist()) == [0.0, 1.0] and len(x) == len(weight) == 2
    found = quality.score(odd, quality.train(odd, labels)).collect()
    assert len(found) == len(ODD_TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert len({r.score for r in found if r.doc_id == 8}) == 1
    none = quality.train(documents(), labels)
    assert quality.score(documents(), none).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(odd, labels.where("false"))).collect()} == {0.5}


def test_sample_is_bounded_and_weighted(spark, documents):
    docs = documents(*((i, f"text {i}") for i in range(40)))
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(40)], LABELS)
    x, y, weight = quality.training_sample(docs, labels, rows=5)
    assert len(x) == 10 and sorted(set(zip(y.tolist(), weight.tolist()))) == [(0.0, 2.0), (1.0, 6.0)]


def test_query_on_held_out_documents(spark):
    from mercaloom.llm.queries import queries

    folder = "/root/testdata/sf0.01"
    found = queries()["op11_boosted_quality"](spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) >= 0.95 * len(held)
