"""Language identification by a convolutional network over bytes, trained in numpy on labelled text.

Filters two, three and four bytes wide read windows of 256 bytes, the largest answer of each filter in a window is
kept, and a softmax layer gives the languages' probabilities. Every byte of a text lies in one window; the last window
is filled with a padding symbol. A document's probabilities are the means over its windows, weighted by their bytes.

Every label and every labelled text is learned, whole: its windows are spread evenly, so that each byte lies in one.
Languages weigh alike: the windows of rarer ones are repeated, at most `REPEATS` times, so that all together at most double, and
weights do the rest; their counts come from all rows. Runs of at most `RUN` neighbouring windows travel as their text,
packed run by run, and are cut again where they are read; they are dealt by hash into shards of about `SHARD` windows and
these into at most `ROUNDS` rounds, stored once. In a round each shard is passed over by a task, from the round's model on,
and the models of its shards are averaged, as whole numbers, so that their order does not matter. So each window is
met once or, if there are few, as often as `STEPS` steps need, more the more languages there are. The model holds some
0.2 MB and 200 bytes a language, so it travels with the tasks. `Model.floor` says how low the best
language's probability gets in labelled windows: all but a thousandth of them, counted in `BINS` steps, lie above.

A null text, or one without a letter, is `und` with score 0; so is every text if no language can be learned. Rows with
equal ids or texts are judged alike, an empty table gives no rows, and input columns with the names of the two results
are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PAD = 256
SYMBOLS = 257
STEPS = 300
LANGUAGES_A_STEP = 16  # beyond so many languages, steps grow with their number
SHARD = 16_384  # windows
RUN = 8  # windows
PACKING, PACKING_LEVEL = "zstd", 3
ROUNDS = 8
REPEATS = 64
FIXED = 1 << 32  # the whole numbers in which models are added up
BINS, FLOOR_SHARE = 1 << 16, 0.001
BATCH = 64
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """Per width the answers of the filters to each symbol at each place; the softmax layer; the languages."""

    taps: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    languages: list[str]
    floor: float = 0.0

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What all filters answer to the pair of symbols at a place, and to the pair two places on."""
        two, three, four = self.taps
        first = [t[0][:, None] + t[1][None] for t in (two, three, four)]
        here = np.concatenate(first, -1) + self.bias
        later = np.concatenate([np.broadcast_to(three[2][:, None], (SYMBOLS, SYMBOLS, FILTERS)), four[2][:, None] + four[3][None]], -1)
        return tuple(np.ascontiguousarray(t.reshape(SYMBOLS * SYMBOLS, -1), np.float32) for t in (here, later))

    def probabilities(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        here, later = tables
        pooled = np.empty((len(windows), here.shape[1]), np.float32)
        for at in range(0, len(windows), BATCH):
            pairs = _pairs(windows[at : at + BATCH])
            answer = here[pairs[:, :-2]]
            answer[:, :, FILTERS:] += later[pairs[:, 2:]]
            pooled[at : at + BATCH] = answer.max(1)
        return _softmax(np.maximum(pooled, 0) @ self.dense + self.offset)


def _pairs(windows: np.ndarray) -> np.ndarray:
    x = np.pad(windows.astype(np.int32), ((0, 0), (0, 3)), constant_values=PAD)
    return x[:, :-1] * SYMBOLS + x[:, 1:]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts as rows of symbols, and how many each text has (one at least)."""
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts], np.int64)
    out = np.full(int(counts.sum()) * WINDOW, PAD, np.uint16)
    for text, at in zip(texts, (np.cumsum(counts) - counts) * WINDOW):
        out[at : at + len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(-1, WINDOW), counts


def untrained(languages: int, seed: int = 7) -> list[np.ndarray]:
    """The values of a model before training."""
    rng = np.random.default_rng(seed)
    n_all = FILTERS * len(WIDTHS)
    taps = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for t in taps:
        t[:, PAD] = 0
    dense = rng.normal(0, 0.2, (n_all, languages)).astype(np.float32)
    return [*taps, np.zeros(n_all, np.float32), dense, np.zeros(languages, np.float32)]


def learn(
    values: list[np.ndarray], windows: np.ndarray, labels: np.ndarray, weights: np.ndarray, passes: int, begin: float, end: float, seed: int
) -> None:
    """Changes the values by Adam on the weighted cross-entropy of the windows, in a new order in each of the passes.

    `begin` and `end` say which part of the whole training this is; the rate falls in its second half.
    """
    rng = np.random.default_rng(seed)
    taps = values[: len(WIDTHS)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    drawn = np.concatenate([rng.permutation(len(windows)) for _ in range(passes)])
    steps = -(-len(drawn) // BATCH)
    buffers = [np.empty((BATCH, WINDOW, sum(FILTERS for t in taps if len(t) > k)), np.float32) for k in range(max(WIDTHS))]
    for step in range(1, steps + 1):
        own = drawn[(step - 1) * BATCH : step * BATCH]
        y, n = labels[own], len(own)
        x = np.pad(windows[own].astype(np.int64), ((0, 0), (0, 3)), constant_values=PAD)
        for k, part in enumerate(buffers):  # the filters that reach k symbols on are the last ones
            reach = np.concatenate([t[k] for t in taps if len(t) > k], 1)
            np.take(reach, x[:, k : k + WINDOW], axis=0, out=part[:n], mode="clip")
            if k:
                buffers[0][:n, :, -part.shape[2] :] += part[:n]
        answer = buffers[0][:n]
        place = answer.argmax(1)
        raw = np.take_along_axis(answer, place[:, None], 1)[:, 0] + values[3]
        h = np.maximum(raw, 0)
        slope = _softmax(h @ values[4] + values[5])
        slope[np.arange(n), y] -= 1
        slope *= weights[y][:, None] / BATCH
        back = (slope @ values[4].T) * (raw > 0)
        rows, grads = np.arange(n)[:, None], []
        for w, width in enumerate(WIDTHS):
            columns = slice(w * FILTERS, (w + 1) * FILTERS)
            at = [(x[rows, place[:, columns] + k] + k * SYMBOLS) * FILTERS + np.arange(FILTERS) for k in range(width)]
            part = np.tile(back[:, columns].ravel(), width)
            part = np.bincount(np.concatenate(at).ravel(), part, width * SYMBOLS * FILTERS).astype(np.float32)
            grads.append(part.reshape(width, SYMBOLS, FILTERS))
            grads[w][:, PAD] = 0
        grads += [back.sum(0), h.T @ slope, slope.sum(0)]
        rate = 0.01 * min(1.0, 2 * (1 - begin - (end - begin) * step / (steps + 1)))
        for v, g, (m, s) in zip(values, grads, moments):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)


def passes_of(drawn: int, languages: int) -> int:
    """How often the windows are passed over."""
    steps = STEPS * -(-languages // LANGUAGES_A_STEP)
    return max(1, -(-BATCH * steps // drawn))


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """A model of windows that are all at hand, each language weighing alike."""
    values, counts = untrained(len(languages), seed), np.bincount(labels, minlength=len(languages))
    weights = (len(labels) / len(languages) / np.maximum(1, counts)).astype(np.float32)
    learn(values, windows, labels, weights, passes_of(len(labels), len(languages)), 0, 1, seed)
    return Model(values[:3], *values[3:], languages)


def spread_windows(data: bytes) -> list[bytes]:
    """As few windows as cover a text, evenly spread; only a text shorter than a window gives a shorter one."""
    n = max(1, -(-len(data) // WINDOW))
    return [data[s : s + WINDOW] for s in np.linspace(0, max(0, len(data) - WINDOW), n).astype(int).tolist()]


def window_runs(data: bytes) -> list[bytes]:
    """The bytes of each run of `RUN` windows; `spread_windows` cuts as many windows of each."""
    n = max(1, -(-len(data) // WINDOW))
    starts = np.linspace(0, max(0, len(data) - WINDOW), n).astype(int).tolist()
    return [data[run[0] : run[-1] + WINDOW] for run in (starts[i : i + RUN] for i in range(0, n, RUN))]


def runs_of(batch: pa.RecordBatch) -> list[bytes]:
    """The runs of rows that `labelled_windows` packed."""
    codec = pa.Codec(PACKING)
    packed = zip(batch.column("part").to_pylist(), batch.column("size").to_pylist())
    return [codec.decompress(part, size, asbytes=True) for part, size in packed]


def _windows_of_runs(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all runs, and how many each has."""
    cut = [spread_windows(run) for run in runs]
    return windows_of([window for windows in cut for window in windows])[0], np.array([len(x) for x in cut], np.int64)


def labelled_windows(labelled: DataFrame, repeats: dict[str, int]) -> DataFrame:
    """Every run of windows of the labelled texts, packed and with its size, as often as its language is repeated."""
    number = {lang: i for i, lang in enumerate(sorted(repeats))}
    names = ["label", "place", "at", "copy", "part", "size"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(PACKING, PACKING_LEVEL)
        for batch in common.slices(batches, "text"):
            out = []
            for lang, place, text in zip(batch.column("lang").to_pylist(), batch.column("place").to_pylist(), common.texts_of(batch)):
                for at, run in enumerate(window_runs(text.encode())):
                    part = codec.compress(run, asbytes=True)
                    out += [(number[lang], place, at, copy, part, len(run)) for copy in range(repeats[lang])]
                    if len(out) > 20_000:
                        yield _batch(out, names, types)
                        out = []
            if out:
                yield _batch(out, names, types)

    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
    rows = labelled.select("lang", F.xxhash64("doc_id", "text").alias("place"), "text")
    return rows.mapInArrow(cut, "label int, place long, at int, copy int, part binary, size int")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, windows and labels of each shard, whose rows follow each other; what equal rows make too long is cut."""

    def shard(parts: list[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
        whole = pa.concat_batches(parts)
        whole = whole.take(pa.array(np.lexsort([whole.column(c).to_numpy() for c in ("copy", "at", "place")])))
        windows, counts = _windows_of_runs(runs_of(whole))
        return whole.column("slot")[0].as_py(), windows, np.repeat(whole.column("label").to_numpy(), counts)

    def many(parts: list[pa.RecordBatch]) -> bool:
        return sum((np.maximum(1, -(-p.column("size").to_numpy() // WINDOW))).sum() for p in parts) > 2 * SHARD

    held: list[pa.RecordBatch] = []
    for batch in batches:
        slot = batch.column("slot").to_numpy()
        edges = [0, *(np.flatnonzero(slot[1:] != slot[:-1]) + 1).tolist(), len(slot)]
        for a, b in zip(edges, edges[1:]):
            if held and (held[-1].column("slot")[0].as_py() != slot[a] or many(held)):
                yield shard(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield shard(held)


def taught(rows: DataFrame, values: list[np.ndarray], weights: np.ndarray, passes: int, begin: float, end: float) -> list[np.ndarray]:
    """The mean of the values that each shard of `rows` makes of the given ones."""

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(sum(v.size for v in values), np.int64), 0
        for slot, windows, labels in _shards(batches):
            own = [v.copy() for v in values]
            learn(own, windows, labels, weights, passes, begin, end, slot)
            total += np.rint(np.concatenate([v.ravel() for v in own]).astype(np.float64) * FIXED).astype(np.int64)
            n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.r_[n, total])], ["k", "v"])

    sums = rows.mapInArrow(teach, "k int, v long").groupBy("k").agg(F.sum("v").alias("v"))
    found = dict(map(tuple, sums.collect()))  # as many rows as the model has values, one more
    if not (n := found.pop(-1, 0)):
        return values
    mean = (np.array([found[k] for k in range(len(found))], np.float64) / (n * FIXED)).astype(np.float32)
    edges = np.cumsum([v.size for v in values])[:-1]
    return [m.reshape(v.shape) for m, v in zip(np.split(mean, edges), values)]


def lowest(rows: DataFrame, model: Model) -> float:
    """The probability of the best language that all but FLOOR_SHARE of the windows exceed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, met = model.tables(), np.zeros(BINS + 1, np.int64)
        for batch in batches:
            best = model.probabilities(_windows_of_runs(runs_of(batch))[0], tables).max(1)
            met += np.bincount((best * BINS).astype(np.int64), minlength=BINS + 1)[: BINS + 1]
        bin_ = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(bin_.astype(np.int32)), pa.array(met[bin_])], ["bin", "n"])

    counted = rows.where("copy = 0").select("part", "size").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n"))
    bins, n = map(np.array, zip(*sorted(map(tuple, counted.collect()))))  # at most BINS rows
    total = np.cumsum(n)
    return float(bins[np.searchsorted(total, FLOOR_SHARE * total[-1], side="right")] / BINS)


def train(docs: DataFrame, with_floor: bool = True) -> Model | None:
    """A model of all rows of `docs` that have a label and a letter."""
    common.bound_batches(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    n_windows = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / WINDOW))
    counts = dict(map(tuple, labelled.groupBy("lang").agg(F.sum(n_windows)).collect()))
    if not counts:
        return None
    languages = sorted(counts)
    fair = sum(counts.values()) / len(counts)
    repeats = {lang: max(1, min(REPEATS, int(fair // n))) for lang, n in counts.items()}
    weights = np.array([fair / (repeats[lang] * counts[lang]) for lang in languages], np.float32)
    drawn = sum(repeats[lang] * n for lang, n in counts.items())
    rounds = min(ROUNDS, -(-drawn // SHARD))
    slots = rounds * -(-drawn // (rounds * SHARD))

    path = common.shared_path(docs.sparkSession, "language-windows")
    slot = F.pmod(F.xxhash64("place", "at", "copy"), F.lit(slots)).cast("int")
    dealt = labelled_windows(labelled, repeats).withColumn("slot", slot).repartitionById(slots, "slot")
    dealt.withColumn("round", F.col("slot") % rounds).write.options(compression="zstd").partitionBy("round").parquet(path)
    schema = "label int, place long, at int, copy int, part binary, size int, slot int, round int"
    windows = docs.sparkSession.read.schema(schema).parquet(path)

    values, passes = untrained(len(languages)), passes_of(drawn, len(languages))
    for i in range(rounds):
        rows = windows.where(F.col("round") == i).drop("round")
        values = taught(rows, values, weights, passes, i / rounds, (i + 1) / rounds)
    model = Model(values[:3], *values[3:], languages)
    model.floor = lowest(windows, model) if with_floor else 0.0
    common.drop_path(docs.sparkSession, path)
    return model


def identify(docs: DataFrame, model: Model | None, prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows of `docs` with the predicted language and its mean probability."""
    common.bound_batches(docs.sparkSession)
    docs = docs.drop(prediction, score)
    if model is None:
        return docs.withColumns({prediction: F.lit(UNKNOWN), score: F.lit(0.0)})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = model.tables(), np.array(model.languages, object)
        for batch in common.slices(batches, "text"):
            texts = common.texts_of(batch)
            windows, counts = windows_of([t.encode() for t in texts])
            by_window = model.probabilities(windows, tables) * (windows != PAD).sum(1, keepdims=True)
            sums = np.add.reduceat(by_window, np.cumsum(counts) - counts)
            means = sums / np.maximum(1e-9, sums.sum(1, keepdims=True))
            has_letter = np.array([bool(LETTER.search(t)) for t in texts])
            best = means.argmax(1)
            names_out = np.where(has_letter, names[best], UNKNOWN)
            scores = np.where(has_letter, np.clip(means[np.arange(len(best)), best], 0, 1), 0.0).astype(float)
            columns = [*batch.columns, pa.array(names_out, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, prediction, score])

    fields = [T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *fields])
    return docs.mapInArrow(judge, schema)


def bucket(key: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo `buckets`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % buckets


def op7_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = bucket(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held_out), with_floor=False)
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
