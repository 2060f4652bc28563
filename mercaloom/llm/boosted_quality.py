"""A quality classifier: histogram gradient-boosted trees over statistics of whole documents.

`statistics` turns texts into `FEATURES` numbers: sizes, words and their repetition, lines, shares of byte classes, entropy
and compressibility; id, language and source are no part of them. `fit` cuts every statistic into `BINS` bins at
quantiles of the training sample and grows complete trees level by level: per node, gradient and curvature of the
logistic loss are summed in one histogram of (node, statistic, bin), and the cut with the best gain splits it. A tenth of
the sample is not fitted and tells after how many trees to stop. The model is three flat arrays (statistic, threshold and
leaf by tree and place), which numpy descends for all rows and trees at once; it has a fixed size and travels with tasks.

The training sample is bounded: of the labelled ids of each class the `ROWS_PER_CLASS` with the smallest hash, weighted by
how many each stands for. All documents are scored, each by its whole text.

An id labelled both ways, or by neither 0 nor 1, or null, trains nothing; of rows that share a labelled id the one with the
smallest statistics trains. Null texts are empty, and empty texts are scored like others. Without labels of both
classes there are no trees and every score is the labels' share of ones (without any, 0.5). Rows of equal ids or texts are
judged alike, an empty table gives no rows, and input columns with the names of the results are replaced by them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .byte_cnn import bucket

ROWS_PER_CLASS = 20_000
BINS = 64
TREES = 200
DEPTH = 4
RATE = 0.1
SHRINK = 2.0
LEAST_WEIGHT = 2.0
PATIENCE = 25
THRESHOLD = 0.3

# Bytes by kind; a text's share of each is a statistic.
BYTE_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "vowel": b"aeiouAEIOU",
    "digit": b"0123456789",
    "space": b" ",
    "blank": b"\t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".",
    "comma": b",",
    "exclamation": b"!",
    "question": b"?",
    "quote": b"\"'`",
    "bracket": b"()[]{}<>",
    "bar": b"|",
    "symbol": b"#$%&*+^~=",
    "joint": b"-_/\\@:;",
    "high": bytes(range(128, 256)),
    "control": bytes(x for x in range(32) if x not in (9, 10, 11, 12, 13)),
}
TEXT_STATISTICS = (
    "bytes", "words", "mean word", "longest word", "distinct words", "most frequent word", "distinct pairs", "distinct triples", "upper words",
    "title words", "words with digits", "one-letter words", "words ended by a mark", "lines", "distinct lines", "mean line",
    "short lines", "lines ended by a mark", "bytes in repeated lines", "words per sentence", "entropy", "compressed",
)
FEATURES = (*TEXT_STATISTICS, *BYTE_KINDS)
_KIND_OF = np.array([[b in members for members in BYTE_KINDS.values()] for b in range(256)], np.float64)
_MARKS = (".", ",", "!", "?", ";", ":")


def _of_words(words: list[str]) -> list[float]:
    n = len(words)
    if not n:
        return [0.0] * 12
    sizes = list(map(len, words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    triples = len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)
    return [
        np.log1p(n), sum(sizes) / n, np.log1p(max(sizes)), len(counts) / n, max(counts.values()) / n, pairs, triples,
        sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
        sum(c for w, c in counts.items() if not w.isalpha() and any(map(str.isdigit, w))) / n,
        sizes.count(1) / n, sum(c for w, c in counts.items() if w[-1] in _MARKS) / n,
    ]


def _of_lines(text: str, n_words: int) -> list[float]:
    lines = text.split("\n")
    n, counts = len(lines), Counter(lines)
    repeated = sum(len(line) * c for line, c in counts.items() if c > 1)
    sentences = text.count(". ") + text.count(".\n") + text.count("!") + text.count("?") + 1
    return [
        np.log1p(n), len(counts) / n, np.log1p(len(text) / n), sum(c for line, c in counts.items() if len(line) < 30) / n,
        sum(c for line, c in counts.items() if line.rstrip()[-1:] in _MARKS[:4]) / n, repeated / max(1, len(text)),
        np.log1p(n_words / sentences),
    ]


def statistics(texts: list[str]) -> np.ndarray:
    """One row of `FEATURES` per text; counts of bytes for all texts at once."""
    data = [t.encode() for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    doc = np.repeat(np.arange(len(data), dtype=np.int64) << 8, sizes)
    counts = np.bincount(doc + np.frombuffer(b"".join(data), np.uint8), minlength=len(data) << 8).reshape(-1, 256)
    shares = counts / np.maximum(1, sizes)[:, None]
    entropy = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(1)
    rows = []
    for text, raw in zip(texts, data):
        words = text.split()
        rows.append([np.log1p(len(raw)), *_of_words(words), *_of_lines(text, len(words)), 0.0, len(zlib.compress(raw, 1)) / max(1, len(raw))])
    out = np.concatenate([np.array(rows, np.float64).reshape(-1, len(TEXT_STATISTICS)), shares @ _KIND_OF], 1)
    out[:, TEXT_STATISTICS.index("entropy")] = entropy
    return out.astype(np.float32)


@dataclass
class Model:
    """Complete trees as flat arrays: per tree the statistic and threshold of its inner places, the values of its leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        place = np.zeros((len(x), len(self.feature)), np.int64)
        trees, rows = np.arange(len(self.feature))[None], np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            right = x[rows, self.feature[trees, place]] > self.threshold[trees, place]
            place = 2 * place + 1 + right
        raw = self.base + self.leaf[trees, place - (2**DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-raw))


def _loss(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * np.logaddexp(0, np.where(y > 0, -raw, raw))).sum() / weight.sum())


def _tree(codes: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree on binned rows: statistics and thresholds of its inner places, leaf values, and the leaf of each row."""
    n, width = codes.shape
    feature, threshold = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf, np.float32)
    node = np.zeros(n, np.int64)
    within = codes + np.arange(width) * BINS
    for level in range(DEPTH):
        nodes = 2**level
        at = (node[:, None] * (width * BINS) + within).ravel()
        sums = [np.bincount(at, np.repeat(v, width), nodes * width * BINS).reshape(nodes, width, BINS).cumsum(2) for v in (g, h)]
        total_g, total_h = (s[:, :1, -1:] for s in sums)
        left_g, left_h = sums
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - total_g**2 / (total_h + SHRINK)
        gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
        best = gain.reshape(nodes, -1).argmax(1)
        f, b = best // BINS, best % BINS
        splits = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
        first = nodes - 1
        for i in np.flatnonzero(splits):
            feature[first + i], threshold[first + i] = f[i], cuts[f[i]][b[i]]
        node = 2 * node + (splits[node] & (codes[np.arange(n), f[node]] > b[node]))
    sums_g, sums_h = (np.bincount(node, v, 2**DEPTH) for v in (g, h))
    return feature, threshold, -RATE * sums_g / (sums_h + SHRINK), node


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 11) -> Model:
    """Boosted trees for the probability that y is 1."""
    total, ones = float(weight.sum()), float(weight[y > 0].sum())
    none = np.zeros((0, 2**DEPTH - 1), np.int64), np.zeros((0, 2**DEPTH - 1), np.float32), np.zeros((0, 2**DEPTH), np.float64)
    if ones in (0.0, total):
        share = 0.5 if not total else min(max(ones / total, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), *none)
    weight = weight * (len(y) / total)
    base = float(np.log(ones / (total - ones)))
    # bins end at quantiles; the last bin of a statistic has no end and is never a cut
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")).astype(np.float32) for c in x.T]
    codes = np.stack([np.searchsorted(cut, c) for cut, c in zip(cuts, x.T)], 1)
    cuts = [np.r_[cut, np.full(BINS - len(cut), np.inf, np.float32)] for cut in cuts]
    tests = np.random.default_rng(seed).random(len(y)) < 0.1
    grown, best, raw = [], (np.inf, 0), np.full(len(y), base)
    for n in range(1, TREES + 1):
        p = 1 / (1 + np.exp(-raw))
        fits = ~tests if tests.any() else np.ones(len(y), bool)
        g, h = (np.where(fits, v, 0.0) for v in (weight * (p - y), weight * p * (1 - p)))
        *tree, leaf_of = _tree(codes, cuts, g, h)
        grown.append(tree)
        raw = raw + tree[2][leaf_of]
        judged = tests if tests.any() else fits
        best = min(best, (_loss(raw[judged], y[judged], weight[judged]), n))
        if n - best[1] >= PATIENCE:
            break
    kept = grown[: best[1]]
    return Model(base, *(np.stack(part) for part in zip(*kept)))


def with_statistics(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """The rows of `docs` with the statistics of `text`, as an array in the order of `FEATURES`."""
    common.bound_batches(docs.sparkSession)
    docs = docs.drop(name)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            x = statistics(common.texts_of(batch))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    return docs.mapInArrow(measure, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))]))


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS_PER_CLASS):
    """Statistics, labels and weights of the bounded sample of labelled documents."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(label).alias("least"), F.max(label).alias("y"))
    known = known.where((F.col("least") == F.col("y")) & F.col("y").isin(0, 1))
    known = known.select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("place"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    classes = [known.where(F.col("y") == y).orderBy("place", "doc_id").limit(rows).select("doc_id", "y") for y in (0, 1)]
    chosen = classes[0].unionAll(classes[1]).withColumnsRenamed({"doc_id": "_chosen"})
    # two times `rows` narrow rows at most; as many rows of statistics come back
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_chosen")).select("doc_id", "y", "text")
    found = with_statistics(texts).groupBy("doc_id").agg(F.min("y").alias("y"), F.min("statistics").alias("x"))
    found = found.orderBy("doc_id").toPandas()
    if found.empty:
        return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0), np.zeros(0)
    y = found["y"].to_numpy(np.float64)
    stands_for = {k: n / max(1, min(n, rows)) for k, n in counts.items()}
    return np.stack(found["x"].to_numpy()).astype(np.float32), y, np.array([stands_for[int(v)] for v in y])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS_PER_CLASS) -> Model:
    return fit(*training_sample(docs, labels, label, rows))


def score(docs: DataFrame, model: Model, name: str = "score", predicted: str = "predicted") -> DataFrame:
    """The rows of `docs` with the probability of label 1, and 1 where it reaches `THRESHOLD`."""
    common.bound_batches(docs.sparkSession)
    docs = docs.drop(name, predicted)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            p = model.probabilities(statistics(common.texts_of(batch)))
            columns = [*batch.columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name, predicted])

    fields = [T.StructField(name, T.DoubleType()), T.StructField(predicted, T.IntegerType())]
    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, *fields]))


def op11_boosted_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.read_table(spark, folder, "documents").select("doc_id", "text")
    labels = common.read_table(spark, folder, "labels").select("doc_id", "quality")
    model = train(docs, labels.where(bucket(F.col("doc_id"), 5) != 0))
    held_out = bucket(F.col("doc_id"), 5) == 0
    return score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
