"""Packing token ids into sequences whose sources keep target proportions: deficit round-robin in closed form.

Every source is a queue of its documents' ids. A round-robin that credits each queue by its weight and serves the most
indebted next gives token k of a queue with weight w the virtual time (2k + 1) / 2w; the deficits carried from window to
window are what these times have not yet served. The place of a token in the merged order is the number of tokens
with a smaller time, a sum over the queues, so every task finds the windows of its own documents by itself: no queue
runs through one task, and the carry crosses partitions and windows alike. Only the last sequence can be short.

Weights are whole numbers up to 2**20, so all comparisons are exact. By default they follow the queues' sizes, so all
queues end together; with other targets a queue that has ended leaves its share to the rest. The 63 largest sources
are queues of their own, all others (and the null source, if small) share one.

Null and empty texts are one end id; rows with equal ids are separate documents; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import common, tokens
from .token_files import crc_of_slices, lists_of, with_end

LENGTH = 1024
QUEUES = 64
SCALE = 1 << 20
SLICE_ROWS = 1000  # neighbours share windows
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def merged_place(queue: int, k: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How many tokens of all queues are served before token `k` of `queue`; equal times go by queue number."""
    own = weights[queue]
    place = np.zeros(len(k), np.int64)
    odd, step = 2 * k + 1, 2 * own
    fits = int(odd.max(initial=0)) * int(weights.max()) < 1 << 62
    for q, (size, weight) in enumerate(zip(sizes, weights)):
        # token j is before if step * j < odd * weight - own, or = for an earlier queue
        if fits:
            turns, rest = np.divmod(odd * weight, step)
        else:  # whole steps first, as many as matter, so that no product leaves 64 bits
            turns, rest = np.divmod(odd % step * weight, step)
            turns += np.minimum(odd // step, size // weight + 2) * weight
        place += np.clip(turns + 1 - (rest < own) if q < queue else turns + (rest > own), 0, size)
    return place


def served(queue: int, places: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How many tokens of `queue` are among the first `places` of the merged order."""
    size, slack = int(sizes[queue]), len(sizes) + 1 + np.ceil(places * 2.0**-44)  # floats err by less
    ends = np.unique(np.concatenate([[0.0], sizes / weights]))
    total = np.minimum(ends[:, None] * weights, sizes).sum(1)

    def near(x: np.ndarray) -> np.ndarray:
        return np.interp(x, total, ends) * weights[queue]

    low = np.clip(np.floor(near(places - slack)) - 2, 0, float(size)).astype(np.int64)
    high = np.minimum(np.clip(np.ceil(near(places + slack)) + 2, 0, float(size)).astype(np.int64), size)
    while (open_ := low < high).any():  # the first token whose place is not below
        middle = (low + high) // 2
        below = merged_place(queue, middle, sizes, weights) < places
        low, high = np.where(open_ & below, middle + 1, low), np.where(open_ & ~below, middle, high)
    return low


def target_weights(totals: np.ndarray, shares: np.ndarray | None = None) -> np.ndarray:
    shares = totals / max(1, totals.sum()) if shares is None else shares / shares.sum()
    return np.maximum(1, np.round(shares * SCALE)).astype(np.int64)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The ids of each document, with its block and how many ids of its source are before it in the block; stored."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = tokens.encoder(vocabulary), TaskContext.get().partitionId()
        before: dict[str | None, int] = {}
        for batch in common.gathered(batches, "text", tokens.SLICE_BYTES):
            ids, offsets = with_end(*encoder.encode(common.texts_of(batch)))
            starts, counts = [], np.diff(offsets)
            for source, n in zip(batch.column("source").to_pylist(), counts.tolist()):
                starts.append(before.get(source, 0))
                before[source] = starts[-1] + n
            columns = [
                pa.array([block] * batch.num_rows, pa.int32()),
                batch.column("doc_id"),
                batch.column("source"),
                pa.array(starts, pa.int64()),
                pa.array(counts),
                lists_of(ids, offsets),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "source", "before", "n_tokens", "ids"])

    schema = "block int, doc_id long, source string, before long, n_tokens long, ids array<int>"
    return common.store(docs.select("doc_id", "source", "text").mapInArrow(encode, schema), "pack")


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    targets: Mapping[str, float] | None = None,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence, with their checksum.

    `targets` gives token shares of sources that are queues of their own; sources not named keep their size as share.
    """
    common.bound_batches(docs.sparkSession)
    stored = encoded(docs, vocabulary or tokens.vocabulary_path())
    sums = stored.groupBy("block", "source").agg(F.sum("n_tokens").alias("n"))
    sums = common.store(sums, "pack-sums")
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n")).where(F.col("source").isNotNull())
    top = [tuple(r) for r in by_source.orderBy(F.desc("n"), "source").limit(QUEUES - 1).collect()]
    number = {source: i for i, (source, _) in enumerate(top)}
    whole = sums.agg(F.sum("n")).first()[0] or 0
    sizes = np.array([n for _, n in top] + [whole - sum(n for _, n in top)], np.int64)
    shares = None if targets is None else np.array([targets.get(s, n / max(1, whole)) for s, n in top] + [sizes[-1] / max(1, whole)])
    weights = target_weights(sizes, shares)

    mapping = F.create_map(*(F.lit(x) for pair in number.items() for x in pair)) if number else None
    queue = F.lit(QUEUES) if mapping is None else F.coalesce(F.try_element_at(mapping, F.col("source")), F.lit(QUEUES))
    order = Window.partitionBy("queue").orderBy("block", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("queue", queue).select(
        "queue", F.col("block").alias("b"), F.col("source").alias("s"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")
    )
    if bases.count() <= common.BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = stored.join(bases, (F.col("block") == F.col("b")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("first"), "n_tokens", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield _pieces(batch.slice(start, SLICE_ROWS), sizes, weights, length, with_ids)

    return placed.mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def _pieces(batch: pa.RecordBatch, sizes: np.ndarray, weights: np.ndarray, length: int, with_ids: bool) -> pa.RecordBatch:
    queue = np.minimum(batch.column("queue").to_numpy(), len(sizes) - 1)
    first, count = batch.column("first").to_numpy(), batch.column("n_tokens").to_numpy()
    lists = batch.column("ids")
    offsets, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    low, high = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    for q in np.unique(queue):
        own = queue == q
        low[own] = merged_place(q, first[own], sizes, weights) // length
        high[own] = merged_place(q, first[own] + count[own] - 1, sizes, weights) // length
    # one row per document and window between its first and its last
    n = high - low + 1
    row = np.repeat(np.arange(len(n)), n)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    windows, at = np.unique(window, return_inverse=True)
    edges = np.unique(np.concatenate([windows, windows + 1]))
    begin, end = np.searchsorted(edges, windows), np.searchsorted(edges, windows + 1)
    piece_from, piece_to, offset = (np.zeros(len(row), np.int64) for _ in range(3))
    before = np.zeros(len(windows), np.int64)  # places of the window taken by earlier queues
    for q in range(len(sizes)):
        served_at = served(q, edges * length, sizes, weights)
        own = queue[row] == q
        w, r = at[own], row[own]
        a, b = served_at[begin[w]], served_at[end[w]]
        piece_from[own] = np.maximum(a, first[r])
        piece_to[own] = np.minimum(b, first[r] + count[r])
        offset[own] = before[w] + piece_from[own] - a
        before += served_at[end] - served_at[begin]
    real = piece_to > piece_from
    row, window, offset, piece_from, piece_to = (x[real] for x in (row, window, offset, piece_from, piece_to))
    start, size = piece_from - first[row], piece_to - piece_from
    # pieces of a document follow each other, so their edges cut the flat ids
    cuts = np.concatenate([[offsets[0]], offsets[0] + np.cumsum(size)])
    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size)]
    columns += [pa.array(crc_of_slices(ids, cuts), pa.int64()), pa.array(count[row]), pa.array(window), pa.array(offset)]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        columns.append(lists_of(ids[cuts[0] : cuts[-1]], cuts - cuts[0]))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def op8_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(common.read_table(spark, folder, "documents"))
