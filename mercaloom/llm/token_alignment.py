"""Alignment of two tokenizers' tokens of the same text, by galloping intersection of the byte offsets where they end.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B), both with a space before it. The
shorter of a text's two lists of token ends drives: each end starts at its proportional place in the longer list,
doubles its steps until the end is passed, and ends by binary search between the last two steps. An end found in both
lists cuts a group; the difference of the ranks of a token's start and end gives the tokens of the other side that
overlap it, its links. All ends of a batch search at once, as lanes of numpy arrays.

Both tokenizers cut at a single space between two other characters (their vocabularies are asked), so such a space is
an end in both lists. Texts are therefore aligned word by word, and a task aligns a word once while it remembers it;
texts in which white space meets are one unit.

On Spark: tasks turn documents into blocks of some megabytes of text (`aligned_blocks`, stored once), each with its
distinct pairs of ids and how often they are linked; `pair_counts` adds them up over all blocks; every block asks for
its distinct pairs (`join_counted` bears pairs that all blocks hold) and gets the answers back beside its documents.
What a block needs for that is packed bytes to Spark, cut into rows of `PIECE_BYTES`, because rows and row groups of
many megabytes fill an executor's heap. New words are aligned some at a time, so that numpy's arrays stay small.

Texts that are null, empty, or not given back byte for byte by either tokenizer have no tokens: zeros, and '' for the
groups. A very long text is a block of its own. Rows of equal ids or texts are rows; a null id is kept; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
BLOCK_BYTES = 4 << 20
# A task forgets its words beyond so many of them, or beyond so many bytes of them and their links.
REMEMBERED_WORDS, REMEMBERED_BYTES = 150_000, 64 << 20
# New units are aligned together up to so many characters; a longer one is aligned alone.
LEARNED_CHARS = 128 << 10
# A row holds at most so many bytes and pairs of a block, and a row group of stored rows ends beyond so many bytes.
PIECE_BYTES, PIECE_PAIRS, ROW_GROUP_BYTES = 256 << 10, 1 << 14, 4 << 20

DOCUMENT_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def gallop(x: np.ndarray, target: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each x the first index in [lo, hi) of the ascending `target` whose value is not below it; there is one.

    Exponential steps from `start` in the direction of x, then binary search between the last two.
    """
    up = target[start] < x
    low, high = np.where(up, start, lo - 1), np.where(up, hi - 1, start)
    lanes, step = np.flatnonzero(high - low > 1), 1
    while len(lanes):
        rises = up[lanes]
        probe = np.where(rises, np.minimum(low[lanes] + step, high[lanes]), np.maximum(high[lanes] - step, low[lanes] + 1))
        reached = target[probe] >= x[lanes]
        high[lanes[reached]], low[lanes[~reached]] = probe[reached], probe[~reached]
        lanes = lanes[(reached != rises) & (high[lanes] - low[lanes] > 1)]
        step *= 2
    lanes = np.flatnonzero(high - low > 1)
    while len(lanes):
        middle = (low[lanes] + high[lanes]) // 2
        reached = target[middle] >= x[lanes]
        high[lanes[reached]], low[lanes[~reached]] = middle[reached], middle[~reached]
        lanes = lanes[high[lanes] - low[lanes] > 1]
    return high


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of all runs in a row."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


def intersect(ends_a: np.ndarray, ends_b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray):
    """Of units of so many tokens each, whose ends lie in a row: whether each end of A and of B is common, and the
    links as (unit, index in A, index in B), ordered by unit."""
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    common_a, common_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links = []
    for a_drives in (True, False):
        units = np.flatnonzero((count_a <= count_b) == a_drives)
        sides = (ends_a, first_a[units], count_a[units], common_a), (ends_b, first_b[units], count_b[units], common_b)
        (short, first, n, short_common), (long, lo, n_long, long_common) = sides if a_drives else sides[::-1]
        driver, unit = _runs(first, n), np.repeat(np.arange(len(units)), n)
        place = lo[unit] + (driver - first[unit]) * n_long[unit] // np.maximum(1, n[unit])
        rank = gallop(short[driver], long, lo[unit], (lo + n_long)[unit], place)
        same = long[rank] == short[driver]
        short_common[driver[same]] = long_common[rank[same]] = True
        # a token's overlap begins after the other side's ends up to its own start, which is the end before it
        begins = np.where(driver == first[unit], lo[unit], np.r_[0, (rank + same)[:-1]] if len(rank) else rank)
        overlap = rank - begins + 1
        pair = np.repeat(driver, overlap), _runs(begins, overlap)
        links.append((np.repeat(units[unit], overlap), *(pair if a_drives else pair[::-1])))
    unit, a, b = (np.concatenate(x) for x in zip(*links))
    order = np.argsort(unit, kind="stable")
    return common_a, common_b, unit[order], a[order], b[order]


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.byte = tokens.Encoder(byte_path)
        self.byte.whole.encode_special_tokens = True
        letters = {letter: b for b, letter in self.byte.letters.items()}
        known = self.byte.whole.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(known.values()) + 1)
        for token, number in known.items():
            self.bytes_a[number] = bytes(map(letters.get, token)) if all(c in letters for c in token) else token.encode()
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        self.bytes_b = [
            bytes([int(n[3:5], 16)]) if self.piece.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in y]) for y in (self.bytes_a, self.bytes_b))
        # no piece holds a space after another character, so no token of B crosses a word's start
        self.cuts = not any(SPACE in n.lstrip(SPACE) for n in names)

    def units(self, text: str) -> list[str]:
        """The words of a text if all tokens end with them, else the text."""
        if not text:
            return []
        return text.split(" ") if self.cuts and not text[0].isspace() and tokens._cuts_alone(text) else [text]

    def encode_a(self, unit: str) -> list[int]:
        """Ids of A of a space and the unit."""
        byte, text = self.byte, " " + unit
        if " " in unit or unit[0].isspace() or not tokens._cuts_alone(unit):
            return byte.whole.encode(text, add_special_tokens=False).ids
        found = []
        for piece in byte.split(text):
            ids = byte.pieces.get(piece)
            if ids is None:
                written = piece.encode().decode("latin-1").translate(byte.letters)
                ids = byte.pieces[piece] = tuple([t.id for t in byte.model.tokenize(written)])
            found += ids
        return found

    def encode_b(self, units: list[str]) -> list[list[int]]:
        return self.piece.encode(units, num_threads=1)


@functools.lru_cache(maxsize=1)
def vocabularies(byte_path: str, piece_path: str) -> Vocabularies:
    """Loaded once by a process, not by each task: the tokenizers library never frees the cache of a model it dropped."""
    return Vocabularies(byte_path, piece_path)


class Aligner:
    """Remembers units (words, or texts that have none) with their counts, groups and pairs of linked ids."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        n_a, n_b = len(vocabularies.bytes_a), len(vocabularies.bytes_b)
        self.shown_a = np.array([b"%d%s" % (i, mark) for mark in (b",", b"|") for i in range(n_a)], object).reshape(2, -1)
        self.shown_b = np.array([b"%d%s" % (i, mark) for mark in (b",", b";", b"") for i in range(n_b)], object).reshape(3, -1)
        self.forget()

    def forget(self) -> None:
        self.place = tokens.Places()
        self.v.byte.pieces.clear()
        self.counts = np.zeros((0, len(DOCUMENT_COUNTS)), np.int64)
        self.good = np.zeros(0, bool)
        self.groups: list[bytes] = []
        self.pairs, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.held = 0
        # what batches of rows took stays with Arrow else, more of it with every block
        pa.default_memory_pool().release_unused()

    def place_all(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's units; new units are aligned, many together."""
        if len(self.place) > REMEMBERED_WORDS or self.held > REMEMBERED_BYTES:
            self.forget()
        known = len(self.place)
        found = []
        for text in texts:
            units = self.v.units(text)
            found.append(np.fromiter(map(self.place.__getitem__, units), np.int64, len(units)))
        new = list(islice(self.place, known, None))
        portion = np.cumsum([len(u) + 1 for u in new], dtype=np.int64) // LEARNED_CHARS
        for start, end in pairwise([0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), len(new)] if new else []):
            self._learn(new[start:end])
        return found

    def _learn(self, units: list[str]) -> None:
        v = self.v
        ids_a, ids_b = [v.encode_a(u) for u in units], v.encode_b(units)
        good = np.zeros(len(units), bool)
        for i, (unit, a, b) in enumerate(zip(units, ids_a, ids_b)):
            data = b" " + unit.encode()
            good[i] = data == b"".join(map(v.bytes_a.__getitem__, a)) and data == b"".join(map(v.bytes_b.__getitem__, b))
            self.held += 120 + 14 * len(data)
        kept = np.flatnonzero(good)
        count_a, count_b = (np.array([len(ids[i]) for i in kept], np.int64) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.array([x for i in kept for x in ids[i]], np.int64) for ids in (ids_a, ids_b))
        # the units have equal sizes on both sides, so one row of offsets serves all of them
        ends_a, ends_b = np.cumsum(v.size_a[flat_a]), np.cumsum(v.size_b[flat_b])
        common_a, common_b, unit, link_a, link_b = intersect(ends_a, ends_b, count_a, count_b)

        counts = np.zeros((len(units), len(DOCUMENT_COUNTS)), np.int64)
        last_a, last_b = np.cumsum(count_a), np.cumsum(count_b)
        cut = np.r_[0, np.cumsum(common_a)]
        counts[kept] = np.c_[count_a, count_b, cut[last_a] - cut[last_a - count_a], np.bincount(unit, minlength=len(kept))]
        self.counts = np.concatenate([self.counts, counts])
        self.good = np.concatenate([self.good, good])
        self.pairs = np.concatenate([self.pairs, flat_a[link_a] * len(v.bytes_b) + flat_b[link_b]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts[:, 3])])

        closes = common_b.astype(np.int64)
        closes[last_b - 1] = 2
        group_a, group_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
        in_group_a, in_group_b = (np.bincount(g, minlength=cut[-1]) for g in (group_a, group_b))
        out = np.empty(len(flat_a) + len(flat_b), object)
        out[np.arange(len(flat_a)) + (np.cumsum(in_group_b) - in_group_b)[group_a]] = self.shown_a[common_a.astype(int), flat_a]
        out[np.arange(len(flat_b)) + np.cumsum(in_group_a)[group_b]] = self.shown_b[closes, flat_b]
        parts, at, shown = out.tolist(), 0, [b""] * len(units)
        for i, n in zip(kept.tolist(), (count_a + count_b).tolist()):
            shown[i] = b"".join(parts[at : at + n])
            at += n
        self.groups += shown

    def is_whole(self, units: np.ndarray) -> bool:
        return len(units) > 0 and bool(self.good[units].all())

    def groups_of(self, units: np.ndarray) -> bytes:
        return b";".join(map(self.groups.__getitem__, units.tolist()))


def _paths(byte_path: str | None, piece_path: str | None) -> tuple[str, str]:
    return byte_path or tokens.vocabulary_path(BYTE_VOCABULARY), piece_path or tokens.vocabulary_path(PIECE_VOCABULARY)


def token_groups(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Every document's groups, written `a1,a2|b1;a3|b2,b3`, beside its id."""
    common.bound_batches(docs.sparkSession)
    paths = _paths(byte_path, piece_path)
    docs = docs.select("doc_id", "text")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies(*paths))
        for batch in common.slices(batches, "text", BLOCK_BYTES):
            units = aligner.place_all(common.texts_of(batch))
            shown = [aligner.groups_of(u).decode() if aligner.is_whole(u) else "" for u in units]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shown, pa.string())], ["doc_id", "groups"])

    return docs.mapInArrow(groups, T.StructType([docs.schema["doc_id"], T.StructField("groups", T.StringType())]))


def _pack(columns: dict[str, pa.Array]) -> bytes:
    """Columns of any lengths as bytes."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns.values()]
    row, sink = pa.RecordBatch.from_arrays(lists, list(columns)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as stream:
        stream.write_batch(row)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(data).read_next_batch()
    return {name: column.values for name, column in zip(row.schema.names, row.columns)}


def _ranks(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ones of numbers below n in order, the place of each number among them, and how often each occurs."""
    times = np.bincount(numbers, minlength=n)
    distinct = np.flatnonzero(times)
    place = np.zeros(n, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[numbers], times[distinct]


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sums of runs of so many values."""
    totals = np.r_[0, np.cumsum(values)]
    return np.diff(totals[np.r_[0, np.cumsum(lengths)]])


def aligned_blocks(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Blocks of documents, stored; a block is one row or more, whose lists and `packed` bytes follow each other by `part`.

    Packed are per document its id, counts, the hash of its groups and its units of the block (`doc_units`, so many as
    `doc_lengths` says); per unit the places of its linked pairs (`unit_pairs`, by `unit_lengths`) among the block's
    distinct pairs (`pairs`, `PIECE_PAIRS` to a part), which are linked `pair_links` times in the block.
    """
    common.bound_batches(docs.sparkSession)
    paths = _paths(byte_path, piece_path)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "block long, part int, packed binary, pairs array<long>, pair_links array<long>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies(*paths))
        number = TaskContext.get().partitionId() << 33
        for number, batch in enumerate(common.slices(batches, "text", BLOCK_BYTES), number):
            found = aligner.place_all(common.texts_of(batch))
            whole = [aligner.is_whole(u) for u in found]
            found = [u if ok else u[:0] for u, ok in zip(found, whole)]
            hashes = [hashlib.sha256(aligner.groups_of(u)).hexdigest() if ok else "" for u, ok in zip(found, whole)]
            flat, lengths = np.concatenate(found), np.array([len(u) for u in found])
            counts = {c: pa.array(_sums(aligner.counts[flat, i], lengths)) for i, c in enumerate(DOCUMENT_COUNTS)}
            units, doc_units, used = _ranks(flat, len(aligner.good))
            n_links = np.diff(aligner.ends)[units]
            keys = aligner.pairs[_runs(aligner.ends[units], n_links)]
            pairs, unit_pairs = np.unique(keys, return_inverse=True)
            pair_links = np.bincount(unit_pairs, np.repeat(used, n_links), len(pairs)).astype(np.int64)
            data = _pack({
                "doc_id": batch.column("doc_id"), **counts, "groups_sha256": pa.array(hashes, pa.string()),
                "doc_lengths": pa.array(lengths, pa.int32()), "doc_units": pa.array(doc_units, pa.int32()),
                "unit_lengths": pa.array(n_links, pa.int32()), "unit_pairs": pa.array(unit_pairs, pa.int32()),
            })
            parts = range(max(math.ceil(len(data) / PIECE_BYTES), math.ceil(len(pairs) / PIECE_PAIRS)))
            columns = [
                pa.array([number] * len(parts), pa.int64()), pa.array(parts, pa.int32()),
                pa.array([data[i * PIECE_BYTES : (i + 1) * PIECE_BYTES] for i in parts], pa.binary()),
                *(pa.array([x[i * PIECE_PAIRS : (i + 1) * PIECE_PAIRS] for i in parts], pa.list_(pa.int64())) for x in (pairs, pair_links)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "part", "packed", "pairs", "pair_links"])

    # without the second setting a row group holds 100 rows at least
    small = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 8}
    return common.store(docs.mapInArrow(align, schema), "alignment-blocks", **small)


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """Each pair of linked ids (`pair` = id of A * `size_b` + id of B): links in the corpus, whether no pair with its id of
    B has more, and how many blocks hold it."""
    in_blocks = blocks.select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("x")).select("x.*")
    pairs = in_blocks.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_links").alias("links"), F.count("*").alias("n_blocks"))
    pairs = common.store(pairs, "alignment-pairs")
    id_b = F.col("pair") % size_b
    highest = pairs.groupBy(id_b.alias("id_b")).agg(F.max("links").alias("highest"))
    # one row for each id of B's vocabulary at most
    with_best = pairs.join(F.broadcast(highest), id_b == F.col("id_b"))
    return with_best.select("pair", "links", (F.col("links") == F.col("highest")).alias("best"), "n_blocks")


def score_documents(blocks: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """The documents of the blocks, whose ids are of the type `key`, with `n_best` and `count_sum`."""
    first = F.col("part").cast("long") * PIECE_PAIRS
    asked = blocks.select(F.col("block").alias("asker"), first.alias("first"), F.posexplode("pairs").alias("place", "pair"))
    asked = asked.select("asker", (F.col("first") + F.col("place")).alias("place"), "pair")
    total = pairs.agg(F.sum("n_blocks")).first()[0] or 0
    answers = common.join_counted(asked, pairs, "pair", "n_blocks", total).select("asker", "place", "links", "best")
    asking = blocks.select("block", "part", "packed")
    counts = (*DOCUMENT_COUNTS, "n_best", "count_sum")
    schema = f"doc_id {key}, " + ", ".join(f"{c} long" for c in counts) + ", groups_sha256 string"

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = _unpack(b"".join(block.sort_by("part").column("packed").to_pylist()))
        doc_units, doc_lengths, unit_pairs, unit_lengths = (
            row[c].to_numpy() for c in ("doc_units", "doc_lengths", "unit_pairs", "unit_lengths")
        )
        in_order = answers.sort_by("place")
        for name, asked in (("n_best", "best"), ("count_sum", "links")):
            values = in_order.column(asked).to_numpy().astype(np.int64)
            by_unit = _sums(values[unit_pairs], unit_lengths)
            row[name] = pa.array(_sums(by_unit[doc_units], doc_lengths))
        names = ["doc_id", *counts, "groups_sha256"]
        return pa.Table.from_arrays([row[c] for c in names], names)

    return asking.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(score, schema)


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    import sentencepiece

    byte_path, piece_path = _paths(byte_path, piece_path)
    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    blocks = aligned_blocks(docs, byte_path, piece_path)
    return score_documents(blocks, pair_counts(blocks, size_b), docs.schema["doc_id"].dataType.simpleString())


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(common.read_table(spark, folder, "documents"))
