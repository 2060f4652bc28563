"""Removal of byte strings that stand elsewhere too, by a hash-compared sort of sampled suffixes.

Sampling. Every window of `SPAN` bytes has one anchor, the smallest hash of its grams of `GRAM` bytes (the first of
equal ones). Equal windows have their anchor at the same place, so a window that stands elsewhere is found by way of the
suffixes that start at anchors, about one in 85. An anchor serves a run of windows; its context is their bytes.

Sorting. Anchors whose gram is met twice bring their contexts together. There the suffixes from the anchors on, and the
reversed prefixes before them, are sorted by mergesort: polynomial prefix hashes give the hash of any run of bytes, so
the common extension of two suffixes is found by binary search and one comparison takes a logarithmic number of steps.
Common extensions of neighbours are then compared byte by byte; should hashes have collided, the sort is done anew on
the bytes. At each distance from the anchor the windows with equal bytes are those in one run of both orders.

A gram met more than `HOT` times is split. Its contexts come alone, each distinct one of a text once with its places, and
Spark counts equal ones, combined before the shuffle: all windows of a context met twice stand elsewhere. Only one of equal
contexts has its windows spelled out, under the hash of their bytes, so their number does not grow with the copies. Hashes
are counted first, then the bytes of those met twice, so that no group holds the copies and no collision matters.

The texts are UTF-8; null is empty; no match crosses texts; rows of equal text remove each other; texts shorter than
the span stay; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .hashing import U64, mix

SPAN, GRAM = 200, 32
REACH = SPAN - GRAM + 1  # grams in a window
HOT = 20_000
BUCKET_ROWS = 20_000
WINDOW_HASH = 8  # bytes; windows of equal hashes are compared
# Places of very frequent grams are broadcast if they were counted and are no more than this; beyond, texts are shuffled.
BROADCAST_PLACES = 2_000_000
PIECE = 1 << 20
SHIFT = 21  # a piece has fewer places than 2**SHIFT
BASE = 0x9E3779B97F4A7C15
KEY = ["_k", "_h"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    return tuple(np.multiply.accumulate(np.r_[np.ones(1, U64), np.full(n, b, U64)], dtype=U64) for b in (BASE, inverse))


_UP, _DOWN = _powers(1 << 16)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) <= n:
        _UP, _DOWN = _powers(n + (1 << 16))
    return _UP, _DOWN


class Hashes:
    """Prefix hashes of bytes; `of(start, length)` hashes runs, equal runs alike wherever they stand.

    `place` gives each byte its exponent, which must rise by one along a run: its place in its context, so that the
    powers stay few. Without it the bytes are one run.
    """

    def __init__(self, data: np.ndarray, place: np.ndarray | None = None):
        n = len(data)
        self.place = np.append(place, place.dtype.type(0)) if place is not None else np.arange(n + 1, dtype=np.int32)
        up, self.down = powers(int(self.place.max()) + 1)
        self.sums = np.zeros(n + 1, U64)
        for at in range(0, n, PIECE):
            part = (data[at : at + PIECE].astype(U64) + U64(1)) * up[self.place[at : min(n, at + PIECE)]]
            np.cumsum(part, out=part)
            self.sums[at + 1 : at + 1 + len(part)] = part + self.sums[at]

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[self.place[start]]


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram, place and the first and last window of each anchor in texts that lie in a row and end at `ends`."""
    n = len(data) - GRAM + 1
    if len(data) < SPAN:
        return np.zeros(0, U64), *(np.zeros(0, np.int64) for _ in range(3))
    hashes = Hashes(data)
    gram = mix((hashes.sums[GRAM:] - hashes.sums[:-GRAM]) * hashes.down[:n])
    ranked = (gram >> U64(SHIFT) << U64(SHIFT)) | np.arange(n, dtype=U64)
    padded = np.full(-(-n // REACH) * REACH, ~U64(0), U64)
    padded[:n] = ranked
    rows = padded.reshape(-1, REACH)
    forward = np.minimum.accumulate(rows, 1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    windows = len(data) - SPAN + 1
    least = np.minimum(backward[:windows], forward[REACH - 1 : REACH - 1 + windows])
    place = (least & U64((1 << SHIFT) - 1)).astype(np.int64)
    start = np.arange(windows)
    whole = np.ones(windows, bool)  # windows that end in the text they start in
    for end in ends[:-1]:
        whole[max(0, end - SPAN + 1) : end] = False
    start, place = start[whole], place[whole]
    change = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]) if len(place) else np.zeros(0, np.int64)
    last = np.r_[change[1:], len(place)] - 1 if len(place) else change
    return gram[place[change]], place[change], start[change], start[last]


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in a row, about PIECE bytes at a time: bytes, ends, the row of each and its place in the text.

    A longer text is cut so that every window lies in one piece.
    """
    rows, bases, parts, total = [], [], [], 0
    for row, text in enumerate(common.texts_of(batch)):
        data = text.encode()
        for base in range(0, max(1, len(data) - SPAN + 1), PIECE):
            part = data[base : base + PIECE + SPAN - 1]
            if len(part) < SPAN:
                continue
            if total and total + len(part) > PIECE + SPAN:
                yield _row(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(bases)
                rows, bases, parts, total = [], [], [], 0
            rows.append(row)
            bases.append(base)
            parts.append(part)
            total += len(part)
    if parts:
        yield _row(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(bases)


def _row(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.uint8)


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(gram, text key, at): `at` packs the place and how far before it the first and last window start."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            for data, ends, rows, bases in pieces(batch):
                gram, place, first, last = anchors(data, ends)
                text = np.searchsorted(ends, first, side="right")
                at = (place - (ends[text] - np.diff(np.r_[0, ends])[text]) + bases[text]) << 16
                at |= ((place - first) << 8) | (place - last)
                keys = [batch.column(c).take(pa.array(rows[text])) for c in KEY]
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), *keys, pa.array(at)], ["gram", *KEY, "at"])

    return docs.mapInArrow(read, "gram long, _k long, _h int, at long")


class Suffixes:
    """Contexts in a row, each with its anchor, sorted forward from the anchors and backward before them."""

    def __init__(self, data: np.ndarray, start: np.ndarray, anchor: np.ndarray, end: np.ndarray, group: np.ndarray):
        self.data, self.anchor, self.group = data, anchor, group
        self.before, self.after = anchor - start, end - anchor
        place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
        self.hashes = Hashes(data, place.astype(np.int32))

    def common(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many bytes i and j share from their anchors on, or before them; binary search over hashes."""
        limit = self.after if forward else self.before
        low, high = np.zeros(len(i), np.int64), np.minimum(limit[i], limit[j])
        a, b = self.anchor[i], self.anchor[j]
        while (low < high).any():
            middle = (low + high + 1) // 2
            shift = 0 if forward else middle
            same = self.hashes.of(a - shift, middle) == self.hashes.of(b - shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before_in_order(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Whether i comes before j: by the first byte that differs, then the shorter, then the number."""
        limit = self.after if forward else self.before
        n = self.common(i, j, forward)
        ended = n >= np.minimum(limit[i], limit[j])
        step = np.where(ended, 0, n if forward else -n - 1)
        last = len(self.data) - 1
        a, b = (self.data[np.clip(self.anchor[x] + step, 0, last)] for x in (i, j))
        by_end = (limit[i] < limit[j]) | ((limit[i] == limit[j]) & (i < j))
        return np.where(ended, by_end, a < b)

    def sort(self, forward: bool) -> np.ndarray:
        """Bottom-up mergesort inside the groups, which lie in a row; all groups take a step together."""
        order = np.arange(len(self.anchor))
        if not len(order):
            return order
        begin = np.maximum.accumulate(np.where(np.r_[True, self.group[1:] != self.group[:-1]], order, 0))
        sizes = np.bincount(begin, minlength=len(order))[begin]
        width = 1
        while (active := np.flatnonzero(sizes > width)).size:
            inside = active - begin[active]
            run = inside // width
            other = begin[active] + (run ^ 1) * width  # the run it is merged with
            limit = begin[active] + sizes[active]
            low, high = np.minimum(other, limit), np.minimum(other + width, limit)
            first = low.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                less = self.before_in_order(order[middle], order[active[open_]], forward)
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            target = begin[active] + (run // 2) * 2 * width + inside % width + (low - first)
            merged = order.copy()
            merged[target] = order[active]
            order, width = merged, 2 * width
        return order

    def sorted(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """The order, and how much each shares with the one before it in its group (-1 at a group's start)."""
        order = self.sort(forward)
        i, j = order[1:], order[:-1]
        shared = np.where(self.group[i] == self.group[j], self.common(i, j, forward), -1)
        if not self._as_bytes(i, j, shared, forward):
            order, shared = self._sorted_bytes(forward)
        return order, np.r_[-1, shared][: len(order)]

    def _as_bytes(self, i: np.ndarray, j: np.ndarray, shared: np.ndarray, forward: bool) -> bool:
        """Whether the bytes of neighbours are equal as far as their hashes say."""
        n = np.maximum(shared, 0)
        for at in range(0, len(n), 1 << 12):
            m = n[at : at + (1 << 12)]
            step = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            step = step if forward else -step - 1
            a, b = (np.repeat(self.anchor[x[at : at + (1 << 12)]], m) + step for x in (i, j))
            if not np.array_equal(self.data[a], self.data[b]):
                return False
        return True

    def _sorted_bytes(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        def text(i: int) -> bytes:
            a = self.anchor[i]
            return self.data[a : a + self.after[i]].tobytes() if forward else self.data[a - self.before[i] : a][::-1].tobytes()

        number = np.r_[0, np.cumsum(self.group[1:] != self.group[:-1])]
        order = np.array(sorted(range(len(self.anchor)), key=lambda i: (number[i], text(i), i)), np.int64)

        def shared(i: int, j: int) -> int:
            a, b = text(i), text(j)
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        return order, np.array([shared(i, j) if number[i] == number[j] else -1 for i, j in zip(order[1:], order)], np.int64)

    def repeated(self) -> np.ndarray:
        """For each context and each distance of a window's start before the anchor: does the window stand elsewhere."""
        n = len(self.anchor)
        (right, r_shared), (left, l_shared) = self.sorted(True), self.sorted(False)
        out = np.zeros((n, REACH), bool)
        r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
        for o in range(min(REACH, int(self.before.max(initial=-1)) + 1)):
            served = np.flatnonzero((self.before >= o) & (self.after >= SPAN - o))
            if len(served) < 2:
                continue
            r_class[right] = np.cumsum(r_shared < SPAN - o)
            l_class[left] = np.cumsum(l_shared < o)
            key = r_class[served] * (n + 1) + l_class[served]
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            found = np.zeros(len(served), bool)
            found[order[1:][same]] = True
            found[order[:-1][same]] = True
            out[served, o] = found
        return out


CONTEXT = "kind int, gram long, _k long, _h int, start long, before int, bytes binary, bucket int"


def contexts(texts: DataFrame, buckets: int) -> DataFrame:
    """The contexts of the anchors listed in `places`; a text that is met twice in a row also reports itself whole."""
    names = ["kind", "gram", *KEY, "start", "before", "bytes", "bucket"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in common.slices(batches, "text"):
            out = []
            for k, h, places, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "places", "text"))):
                data = text.encode()
                if (k, h) == last:
                    if len(data) >= SPAN:
                        out.append((1, 0, k, h, 0, len(data), b"", k % buckets))
                    continue
                last = (k, h)
                for p in places:
                    at, gram = p["at"], p["gram"]
                    place, far, near = at >> 16, (at >> 8) & 255, at & 255
                    out.append((0, gram, k, h, place - far, far, data[place - far : place - near + SPAN], gram % buckets))
                if len(out) > 20_000:
                    yield _batch(out, names)
                    out = []
            yield _batch(out, names)

    return texts.mapInArrow(read, CONTEXT)


def hot_contexts(texts: DataFrame) -> DataFrame:
    """The distinct contexts in a text of the anchors listed in `places`. Of equal texts in a row the first is enough: all go."""
    names, types = [*KEY, "starts", "bytes"], [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in common.slices(batches, "text"):
            out = []
            for k, h, places, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "places", "text"))):
                if (k, h) == last:
                    continue
                last, data = (k, h), text.encode()
                starts: dict[bytes, list[int]] = {}
                for p in places:
                    place, far, near = p["at"] >> 16, (p["at"] >> 8) & 255, p["at"] & 255
                    starts.setdefault(data[place - far : place - near + SPAN], []).append(place - far)
                out += [(k, h, at, context) for context, at in starts.items()]
                if len(out) > 20_000:
                    yield _batch(out, names, types)
                    out = []
            yield _batch(out, names, types)

    return texts.mapInArrow(read, "_k long, _h int, starts array<long>, bytes binary")


def hot_windows(classes: DataFrame) -> DataFrame:
    """The windows of distinct contexts: which context, how far from its start, the hash and the bytes."""
    names, types, size = ["class", "at", "gram", "bytes"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()], WINDOW_HASH

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, context in zip(batch.column("class").to_pylist(), batch.column("bytes").to_pylist()):
                for at in range(len(context) - SPAN + 1):
                    window = context[at : at + SPAN]
                    key = int.from_bytes(hashlib.blake2b(window, digest_size=size).digest(), "big", signed=True)
                    out.append((number, at, key, window))
                if len(out) > 20_000:
                    yield _batch(out, names, types)
                    out = []
            yield _batch(out, names, types)

    return classes.select("class", "bytes").mapInArrow(spell, "class long, at int, gram long, bytes binary")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """The runs of hot windows that stand elsewhere.

    Contexts and windows are stored once. Hashes of windows are counted first; the bytes of those that are met twice
    travel after that.
    """
    found = common.store(hot_contexts(texts), "suffix-hot")
    classes = found.groupBy("bytes").agg(F.count("*").alias("rows"), F.sum(F.size("starts")).alias("met"))
    classes = common.store(classes.withColumn("class", F.monotonically_increasing_id()), "suffix-classes")
    windows = common.store(hot_windows(classes), "suffix-windows")
    hashes = common.store(windows.groupBy("gram").agg(F.count("*").alias("met")).where("met > 1"), "suffix-hashes")
    n, total = hashes.agg(F.count("*"), F.sum("met")).first()
    if n <= common.BROADCAST_ROWS:
        likely = windows.join(F.broadcast(hashes), "gram")
    else:
        likely = common.join_counted(windows, hashes, "gram", "met", total).where("met is not null")
    likely = likely.select("class", "at", "bytes")
    equal = common.store(likely.groupBy("bytes").agg(F.count("*").alias("met")).where("met > 1"), "suffix-equal")
    total = equal.agg(F.sum("met")).first()[0] or 0
    again = common.join_counted(likely, equal, "bytes", "met", total).where("met is not null")
    again = again.groupBy("class").agg(F.collect_set("at").alias("ats"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))

    single = F.transform("ats", lambda at: span(at, at + SPAN))
    spans = F.when(F.col("met") > 1, F.array(span(F.lit(0), F.length("bytes")))).otherwise(single)
    spans = classes.join(again, "class", "left").select("bytes", "rows", spans.alias("spans")).where("spans is not null")
    spans = common.store(spans, "suffix-spans")
    total = spans.agg(F.sum("rows")).first()[0] or 0
    runs = common.join_counted(found, spans, "bytes", "rows", total).where("spans is not null")
    runs = runs.select(*KEY, "spans", F.explode("starts").alias("first")).select(*KEY, "first", F.explode("spans").alias("s"))
    return runs.select(*KEY, (F.col("first") + F.col("s.start")).alias("start"), (F.col("first") + F.col("s.end")).alias("end"))


_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType] = _TYPES) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def covered_runs(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the contexts of a bucket the runs of bytes that stand elsewhere too: (text key, start, end)."""
    whole = frame[frame["kind"] == 1]
    frame = frame[frame["kind"] == 0].sort_values("gram", kind="stable")
    parts = list(frame["bytes"])
    ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
    starts = ends - np.array([len(p) for p in parts], np.int64)
    before = frame["before"].to_numpy().astype(np.int64)
    found = Suffixes(_row(parts), starts, starts + before, ends, frame["gram"].to_numpy()).repeated()
    # along a row the window starts go backward; a run of them covers the bytes from its first to its last end
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (row, near), (_, far) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    anchor = frame["start"].to_numpy()[row] + before[row]
    out = {c: np.r_[frame[c].to_numpy()[row], whole[c].to_numpy()] for c in KEY}
    return pd.DataFrame(
        out | {"start": np.r_[anchor - far + 1, whole["start"].to_numpy()], "end": np.r_[anchor - near + SPAN, whole["before"].to_numpy()]}
    )


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of a set of runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.r_[True, starts[1:] > ends[:-1]]
    return starts[fresh], np.r_[ends[:-1][fresh[1:]], ends[-1:]]


def removed_runs(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans, kept_sha256, the removed `spans` and, if asked for, the kept text.

    Both joins with the texts read one shuffle of them.
    """
    common.bound_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumns({"_k": F.xxhash64("text"), "_h": F.hash("text")})
    rows = anchor_rows(texts.select(*KEY, "text"))
    twice = common.store(rows.groupBy("gram").agg(F.count("*").alias("met")).where("met > 1"), "suffix-grams")
    total = twice.agg(F.sum("met")).first()[0] or 0
    met = common.join_counted(rows, twice, "gram", "met", total).where(F.col("met").isNotNull())
    places = met.groupBy(*KEY).agg(F.collect_set(F.struct("at", "gram", (F.col("met") > HOT).alias("hot"))).alias("places"))
    places = common.store(places, "suffix-places")
    cold = twice.where(F.col("met") <= HOT).agg(F.sum("met")).first()[0] or 0
    buckets = max(1, cold // BUCKET_ROWS)
    few = F.filter("places", lambda p: ~p["hot"])
    listed = texts.join(places.select(*KEY, few.alias("places")), KEY, "left")
    listed = listed.withColumn("places", F.coalesce("places", F.array())).select(*KEY, "places", "text")
    found, hot_runs = contexts(listed, buckets), None
    if total > cold:
        many = places.select(*KEY, F.filter("places", lambda p: p["hot"]).alias("places")).where(F.size("places") > 0)
        many = F.broadcast(many) if (many.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_PLACES else many
        hot_runs = repeated_windows(texts.join(many, KEY).select(*KEY, "places", "text"))
    runs = found.groupBy("bucket").applyInPandas(covered_runs, "_k long, _h int, start long, end long")
    runs = runs.unionByName(hot_runs) if hot_runs is not None else runs
    runs = runs.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    joined = texts.join(runs, KEY, "left").select("doc_id", "runs", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            out = []
            for doc_id, runs, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "runs", "text"))):
                data = text.encode()
                spans: list[tuple[int, int]] = []
                if runs:
                    a, b = (np.array([r[c] for r in runs], np.int64) for c in ("start", "end"))
                    spans = list(zip(*(x.tolist() for x in merged(a, b))))
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans)
                out.append((*row, kept) if with_text else row)
            columns = list(zip(*out)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()][: 7 if with_text else 6]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    schema += ", kept binary" * with_text
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: len(types)]
    return joined.mapInArrow(cut, schema)


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed_runs(common.read_table(spark, folder, "documents")).drop("spans")
