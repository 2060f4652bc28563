"""Lempel-Ziv phrase fingerprints: the dictionary phrases of a text, hashed, in a minimum-hash signature.

A text is parsed from left to right: each phrase is the shortest run of characters that is not in the text's dictionary
yet, and enters it. The likeness of two texts is that of their phrase sets (Jaccard), which follows how well one's
dictionary compresses the other; it is estimated by a signature of 128 bins, each with the smallest phrase hash that
falls into it, shown as 16 bits. An empty bin borrows from the next filled one. Equal texts have equal signatures.

`with_next` pairs every document with the next in descending order of ids (after the last: the first) in one shuffle:
the rows go to ranges of ids, each with a copy of the first row of the range that follows.

Null and empty texts have no phrases; two of them are alike (1), one and another text are not (0). Rows of equal ids
follow each other in the order of their texts; a null id comes after all others; the next of a single row is itself; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .hashing import U64, mix

BINS = 128
SHIFT = U64(57)
BASE = 0x9E3779B97F4A7C15
NO_ID = -(1 << 63)
_starts = np.arange(BINS, dtype=U64) << SHIFT


def phrase_ends(text: str, known: set[str], start: int = 0) -> list[int]:
    """Where the phrases of text[start:] end, with `known` as the dictionary, which grows."""
    ends = []
    add, found = known.add, ends.append
    for end in range(start + 1, len(text) + 1):
        phrase = text[start:end]
        if phrase not in known:
            add(phrase)
            found(end)
            start = end
    return ends


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            inverse = pow(BASE, -1, 1 << 64)
            size = max(1024, 2 * n)
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.ones(1, U64), np.full(size, b, U64)], dtype=U64) for b in (BASE, inverse)
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """A hash of each phrase by its characters alone, from prefix sums of a polynomial."""
    if not ends:
        return np.zeros(0, U64)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(U64) + U64(1)
    up, down = _powers.to(len(codes) + 1)
    sums = np.r_[np.zeros(1, U64), np.cumsum(codes * up[: len(codes)], dtype=U64)]
    end = np.array(ends)
    start = np.r_[0, end[:-1]]
    return mix((sums[end] - sums[start]) * down[start])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The 16-bit values of the bins."""
    if not len(hashes):
        return np.zeros(BINS, np.uint16)
    ordered = np.sort(hashes)
    at = np.searchsorted(ordered, _starts)
    first = ordered[np.minimum(at, len(ordered) - 1)]
    filled = (at < len(ordered)) & (first >> SHIFT == np.arange(BINS, dtype=U64))
    # the next filled bin, counted round; how far it is marks a borrowed value
    places = np.flatnonzero(filled)
    lender = places[np.searchsorted(places, np.arange(BINS)) % len(places)]
    distance = (lender - np.arange(BINS)) % BINS
    return ((mix(first[lender] + distance.astype(U64), 3) >> U64(48)) | U64(1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def shown(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


class Parsed:
    """A text with its phrases and signature."""

    def __init__(self, text: str):
        self.text = text
        self.ends = phrase_ends(text, set())
        self.signature = signature(phrase_hashes(text, self.ends))

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The text with its last half replaced by the start of the other; the parse of the common part is kept."""
        half = len(self.text) // 2
        cut = len(self.text) - half
        text = self.text[:cut] + other[:half]
        common_ends = self.ends[: np.searchsorted(self.ends, cut, side="right")] if self.ends else []
        starts = [0, *common_ends]
        known = {self.text[a:b] for a, b in zip(starts, starts[1:])}
        ends = [*common_ends, *phrase_ends(text, known, starts[-1])]
        return text, signature(phrase_hashes(text, ends))


def in_ranges(docs: DataFrame) -> DataFrame:
    """Sorted ranges of (copy, key, doc_id, text), each closed by copies of the first row of the next range."""
    common.bound_batches(docs.sparkSession)
    parts = common.shuffle_parts(docs.sparkSession)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    bounds = common.range_bounds(keyed, "key", parts)
    placed = keyed.withColumn("part", common.range_number(F.col("key"), bounds))
    heads = sorted(tuple(r) for r in placed.groupBy("part").agg(F.max("key")).collect())  # one row per range
    targets = {key: heads[(i + 1) % len(heads)][0] for i, (_, key) in enumerate(heads)}
    copy = F.lit(None).cast("int")
    if targets:
        copy = F.try_element_at(F.create_map(*(F.lit(x) for kv in targets.items() for x in kv)), F.col("key"))
    places = F.array_compact(
        F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("copy")), F.when(copy.isNotNull(), F.struct(copy.alias("part"), F.lit(1).alias("copy"))))
    )
    spread = placed.select(F.explode(places).alias("at"), "key", "doc_id", "text").select("at.part", "at.copy", "key", "doc_id", "text")
    dealt = spread.repartitionById(len(bounds) + 1, "part")
    return dealt.sortWithinPartitions("copy", F.desc("key"), "text").select("copy", "doc_id", "text")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The signatures of each text and its edited text, and how like they and the next document's are."""
    names = [c.split()[0] for c in RESULT.split(", ")]

    def row(doc_id: int | None, own: Parsed, next_: Parsed) -> tuple:
        text, sig = own.edited(next_.text)
        digest = hashlib.sha256(text.encode()).hexdigest()
        near = likeness(own.signature, sig), likeness(own.signature, next_.signature)
        return (doc_id, len(own.text), digest, shown(own.signature), shown(sig), *near)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[int | None, Parsed] | None = None
        closed = False  # by the first copy
        for batch in common.slices(batches, "text"):
            out = []
            for copy, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("copy", "doc_id", "text"))):
                if closed:
                    break
                closed = bool(copy)
                parsed = waiting[1] if waiting and waiting[1].text == text else Parsed(text)
                if waiting:
                    out.append(row(*waiting, parsed))
                waiting = (doc_id, parsed)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, _types)], names)

    return in_ranges(docs).mapInArrow(parse, RESULT)


_types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def op5_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(common.read_table(spark, folder, "documents"))
