"""Language-model scoring by an Elias-Fano n-gram trie, built and queried in shards.

Model. Trigrams with hierarchical Dirichlet smoothing over the unigrams of the contract's base score:
    p(c | a, b) = (n(abc) + M3 * p(c | b)) / (n(ab) + M3),  p(c | b) = (n(bc) + M2 * p(c)) / (n(b) + M2).
A text starts after two begin signs and ends with the end token. A word so frequent that it would fill more than one
shard is split by a hash of the word before it. n(abc) and n(ab) are whole there; n(b) is the word's training count, and
n(bc) is counted over all splits by pairs dealt by hash, so the shards change no count.

Trie. A shard holds the contexts b it is dealt; per context the successors c, and per (b, a) the successors again, each
as its place among the successors of b (the shorter context), which are few, so the numbers are small. Contexts,
pointers and successors are monotone Elias-Fano sequences, the smoothed parts 16-bit codes of logarithms. The levels
are written to a file that the task maps into memory, and searched from there: the successor of c in b's range gives its
place, the successor of the place in the range of (b, a) the trigram.

Jobs. Texts are read once into stored blocks of local word numbers. Each block asks the shards of the vocabulary for
its words (counts, and numbers that grow with rarity), then the shards of the trie for its distinct trigrams, whose
training counts come along and are what the shard is built from. So a word or trigram is one row per block at most,
whatever its share, and answers are a few bytes each. Nothing is pruned or capped.

Words are lower-cased (A-Z) runs between ASCII white space; null and empty texts are the end token alone; rows of equal
id are separate; a null id is held out or not as the empty text would be; an empty table gives no rows; with no training
rows all counts are 0.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import common
from .elias_fano import EliasFano
from .hashing import U64, lower_words, mix

BLOCK_BYTES = 12 << 20
SHARD_WORDS = 600_000
SHARD_TRIGRAMS = 1_500_000
M2, M3 = 8.0, 1.0
ADD = 0.1
DEPTH = 12.0  # logarithms of parts are coded from -DEPTH to 0
CODES = 65_534
BEGIN, END, FIRST_WORD = 0, 1, 2
SPLIT_BITS = 20
SPLIT = (1 << SPLIT_BITS) - 1  # the bits of a key that number the split of a context, 0 if it is whole


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed by planes of bytes."""
    values = np.ascontiguousarray(values, "<u8")
    wide = 8 if len(values) and int(values.max()) >> 32 else 4
    planes = values.view(np.uint8).reshape(-1, 8)[:, :wide].T
    return bytes([wide]) + zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    wide = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(wide, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :wide] = planes.T
    return out.view("<u8").ravel()


def codes(part: np.ndarray) -> np.ndarray:
    """Logarithms of parts as 16-bit codes; 0 is the code of none."""
    with np.errstate(divide="ignore"):
        log = np.maximum(np.log10(part), -DEPTH)
    return np.where(part > 0, 1 + np.round((log + DEPTH) / DEPTH * CODES), 0).astype(np.uint16)


def parts(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10 ** ((code - 1.0) / CODES * DEPTH - DEPTH), 0.0)


class Levels:
    """The levels of a shard: named arrays, written one after the other into a file and mapped from there."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    def save(self, file) -> dict[str, tuple[int, int, str]]:
        index = {}
        for name, a in self.arrays.items():
            file.write(b"\0" * (-file.tell() % 8))
            index[name] = (file.tell(), len(a), a.dtype.str)
            file.write(a.tobytes())
        file.flush()
        return index

    @classmethod
    def mapped(cls, file, index: dict[str, tuple[int, int, str]]) -> Levels:
        if not os.fstat(file.fileno()).st_size:
            return cls({n: np.zeros(0, t) for n, (_, _, t) in index.items()})
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        return cls({n: np.frombuffer(view, t, k, at) for n, (at, k, t) in index.items()})

    def sequence(self, name: str) -> EliasFano:
        return EliasFano.from_arrays({k: self.arrays[f"{name}.{k}"] for k in ("shape", "low", "high", "samples", "places")})


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys starts in sorted rows."""
    change = reduce(np.logical_or, (k[1:] != k[:-1] for k in keys))
    return np.flatnonzero(np.r_[True, change]) if len(keys[0]) else np.zeros(0, np.int64)


def build(context: np.ndarray, before: np.ndarray, word: np.ndarray, count: np.ndarray) -> Levels:
    """The levels of the trigrams (before, context, word) with positive counts; rows may repeat."""
    seen = count > 0
    context, before, word, count = (x[seen] for x in (context, before, word, count))
    contexts, j = np.unique(context, return_inverse=True)
    wide = U64(max(int(word.max(initial=0)), int(before.max(initial=0))) + 1)
    j64 = j.astype(U64)
    # successors of each context
    pair, at = np.unique(j64 * wide + word, return_inverse=True)
    pair_count, context_count = np.bincount(at, count, len(pair)), np.bincount(j, count, len(contexts))
    owner = (pair // wide).astype(np.int64)
    first = np.searchsorted(owner, np.arange(len(contexts) + 1))
    # successors of each longer context, as places among those of the shorter
    longer, m = np.unique(j64 * wide + before, return_inverse=True)
    longer_count = np.bincount(m, count, len(longer))
    place = at - first[j]
    span = U64(int((first[1:] - first[:-1]).max(initial=0)) + 1)
    triple, t = np.unique(m.astype(U64) * span + place.astype(U64), return_inverse=True)
    triple_count = np.bincount(t, count, len(triple))
    triple_owner = (triple // span).astype(np.int64)
    sequences = {"contexts": contexts, "pairs": pair, "first": first, "longer": longer, "triples": triple}
    arrays = {f"{n}.{k}": a for n, s in sequences.items() for k, a in EliasFano.of(s).arrays().items()}
    arrays["wide"], arrays["span"] = np.array([wide]), np.array([span])
    arrays["context_rest"] = codes(M2 / (context_count + M2))
    arrays["pair_part"] = codes(pair_count / (context_count[owner] + M2))
    arrays["longer_rest"] = codes(M3 / (longer_count + M3))
    arrays["triple_part"] = codes(triple_count / (longer_count[triple_owner] + M3))
    return Levels(arrays)


def look_up(
    levels: Levels, context: np.ndarray, before: np.ndarray, word: np.ndarray, split: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(part, rest) of each trigram: its probability is part + rest * p(word), or part + rest * p(word | context) if split."""
    wide, span = levels.arrays["wide"][0], levels.arrays["span"][0]
    part, rest = np.zeros(len(context)), np.ones(len(context))
    j, known = levels.sequence("contexts").successor(context)
    known = np.flatnonzero(known)
    j = j[known]
    base = j.astype(U64) * wide
    first = levels.sequence("first").decode().astype(np.int64)
    pair, has_pair = levels.sequence("pairs").successor(base + np.minimum(word[known], wide - U64(1)))
    has_pair &= word[known] < wide
    longer, has_longer = levels.sequence("longer").successor(base + np.minimum(before[known], wide - U64(1)))
    has_longer &= before[known] < wide
    place = np.where(has_pair, pair - first[j], 0).astype(U64)
    triple, has_triple = levels.sequence("triples").successor(np.where(has_longer, longer, 0).astype(U64) * span + place)
    has_triple &= has_pair & has_longer

    def of(name: str, index: np.ndarray, has: np.ndarray, other: float) -> np.ndarray:
        table = levels.arrays[name]
        if not len(table):
            return np.full(len(index), other)
        return np.where(has, parts(table[np.minimum(index, len(table) - 1)]), other)

    rest3 = of("longer_rest", longer, has_longer, 1.0)
    whole = np.ones(len(known), bool) if split is None else ~split[known]
    part[known] = of("triple_part", triple, has_triple, 0.0) + rest3 * np.where(whole, of("pair_part", pair, has_pair, 0.0), 0.0)
    rest[known] = rest3 * np.where(whole, parts(levels.arrays["context_rest"][j]), 1.0)
    return part, rest


def pair_counts(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each row the sum of the counts of all rows of its pair (context, word)."""
    wide = U64(int(word.max(initial=0)) + 1)
    _, at = np.unique(context * wide + word, return_inverse=True)
    return np.bincount(at, count)[at].astype(np.int64)


# ------------------------------------------------------------------ blocks


def blocks(docs: DataFrame) -> DataFrame:
    """Stored blocks of documents: ids, held-out flags, word counts, local word numbers, words, training counts."""

    def close(docs_: list[tuple], place: dict[bytes, int], flat: list[np.ndarray], number: int) -> pa.RecordBatch:
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        trains = np.repeat([not held for _, held, _ in docs_], [n for _, _, n in docs_])
        train = np.bincount(ids[trains], minlength=len(place))
        columns = [
            pa.array([number], pa.int64()),
            *(pa.array([list(c)], pa.list_(t)) for c, t in zip(zip(*docs_), (pa.int64(), pa.bool_(), pa.int64()))),
            pa.array([packed(ids)], pa.binary()),
            pa.array([b" ".join(place)], pa.binary()),
            pa.array([packed(train)], pa.binary()),
            pa.array([len(place)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "held", "n", "ids", "words", "train", "n_words"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs_, place, flat, size = [], {}, [], 0
        for batch in common.slices(batches, "text"):
            held = batch.column("held").to_pylist()
            for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), held, common.texts_of(batch)):
                words = lower_words(text)
                flat.append(np.array([place.setdefault(w, len(place)) for w in words], np.int64))
                docs_.append((doc_id, out, len(words)))
                size += len(text) + 1
                if size > BLOCK_BYTES:
                    yield close(docs_, place, flat, number)
                    number += 1
                    docs_, place, flat, size = [], {}, [], 0
        if docs_:
            yield close(docs_, place, flat, number)

    schema = (
        "block long, doc_id array<long>, held array<boolean>, n array<long>, ids binary, words binary, train binary, n_words long"
    )
    return common.store(docs.mapInArrow(read, schema), "lm-blocks")


def _word_shards(words: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each shard's words are: their order by shard, and the shard of each."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    shard = (hashes % U64(shards)).astype(np.int64)
    return np.argsort(shard, kind="stable"), shard


def _split(data: bytes) -> list[bytes]:
    return data.split(b" ") if data else []


def word_answers(stored: DataFrame, shards: int) -> DataFrame:
    """Numbers and training counts of each block's words, by shard; block -1 holds the shard's totals."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, train in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "train"))):
                words, train = np.array(_split(words), object), unpacked(train)
                order, shard = _word_shards(list(words), shards)
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                rows = [
                    (block, s, b" ".join(words[order[a:b]]), packed(train[order[a:b]]))
                    for s, (a, b) in enumerate(zip(edges, edges[1:]))
                    if b > a
                ]
                columns = list(zip(*rows)) or [[]] * 4
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["block", "shard", "words", "train"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        shard, place = int(frame["shard"].iloc[0]), {}
        local = [np.array([place.setdefault(w, len(place)) for w in _split(words)], np.int64) for words in frame["words"]]
        count = np.zeros(len(place), np.int64)
        for ids, train in zip(local, frame["train"]):
            count[ids] += unpacked(train).astype(np.int64)  # a word stands once in a request
        # numbers grow with rarity; equal counts go by the word
        names = sorted(place)
        rank = np.empty(len(place), np.int64)
        by_name = np.array([place[w] for w in names], np.int64)
        rank[by_name[np.argsort(-count[by_name], kind="stable")]] = np.arange(len(place))
        number = rank * shards + shard + FIRST_WORD
        return pd.DataFrame(
            {
                "block": [-1, *frame["block"]],
                "shard": shard,
                "a": [packed(np.array([int(count.sum()), int((count > 0).sum())])), *(packed(number[i]) for i in local)],
                "b": [b"", *(packed(count[i]) for i in local)],
            }
        )

    asked = stored.select("block", "words", "train").mapInArrow(ask, "block long, shard long, words binary, train binary")
    return common.store(asked.groupBy("shard").applyInPandas(answer, "block long, shard long, a binary, b binary"), "lm-words")


class Block:
    """A block with the numbers and counts of its words, as its distinct trigrams in the order of the trie's shards."""

    def __init__(self, row: pd.Series, answers: pd.DataFrame, word_shards: int, trie_shards: int, total: int, train_texts: int):
        self.doc_ids, self.held, self.n = (np.array(list(row[c]), t) for c, t in (("doc_id", object), ("held", bool), ("n", np.int64)))
        words = _split(row["words"])
        order, _ = _word_shards(words, word_shards)
        answers = answers.sort_values("shard")
        number, count = np.zeros(len(words), U64), np.zeros(len(words), np.int64)
        number[order] = np.concatenate([unpacked(a) for a in answers["a"]] or [np.zeros(0, U64)])
        count[order] = np.concatenate([unpacked(b) for b in answers["b"]] or [np.zeros(0, U64)]).astype(np.int64)
        self.count, ids = count, unpacked(row["ids"]).astype(np.int64)
        # local numbers: the words, then begin and end; the row of all tokens has two begins and an end per text
        begin, end = len(words), len(words) + 1
        self.number = np.r_[number, np.array([BEGIN, END], U64)]
        ends = np.cumsum(self.n + 3)
        row_ = np.full(int(ends[-1]) if len(ends) else 0, begin, np.int64)
        row_[ends - 1] = end
        word_at = np.arange(len(ids)) + np.repeat(3 * np.arange(len(self.n)) + 2, self.n)
        row_[word_at] = ids
        scored = np.ones(len(row_), bool)
        scored[ends - self.n - 3] = scored[ends - self.n - 2] = False
        at = np.flatnonzero(scored)
        self.token = row_[at]
        self.text = np.repeat(np.arange(len(self.n)), self.n + 1)
        # splits of frequent contexts
        share = np.r_[count, int(total), 0] if len(words) else np.array([int(total), 0])
        splits = np.minimum(1 + (share * trie_shards // max(1, total)).astype(np.int64), SPLIT)
        context, before = row_[at - 1], row_[at - 2]
        part = (mix(self.number[before], 41) % splits[context].astype(U64)).astype(U64) + U64(1)
        key = (self.number[context] << U64(SPLIT_BITS)) | np.where(splits[context] > 1, part, U64(0))
        shard = (mix(key, 42) % U64(trie_shards)).astype(np.int64)
        # distinct (shard, key, before, word), found by numbering the longer contexts first
        keys, k = np.unique(key, return_inverse=True)
        pairs, p = np.unique((k.astype(np.int64) << 32) | before, return_inverse=True)
        trigram, first, inverse = np.unique((p.astype(np.int64) << 32) | self.token, return_index=True, return_inverse=True)
        deal = np.argsort(shard[first], kind="stable")
        back = np.empty(len(deal), np.int64)
        back[deal] = np.arange(len(deal))
        self.inverse, first = back[inverse], first[deal]
        self.key, self.before, self.word = key[first], self.number[before[first]], self.number[self.token[first]]
        self.train = np.bincount(self.inverse, ~self.held[self.text], len(first)).astype(np.int64)
        self.edges = np.searchsorted(shard[first], np.arange(trie_shards + 1))
        # the distinct pairs (context, word) of split contexts, in the order of the shards that count them
        self.split = splits[context[first]] > 1
        of_split = context[first][self.split]
        self.split_count = np.r_[count, train_texts, 0][of_split]  # a word is a context as often as it stands
        two, at_two = np.unique((of_split.astype(np.int64) << 32) | self.token[first][self.split], return_inverse=True)
        pair_context, pair_word = self.number[two >> 32], self.number[two & 0xFFFFFFFF]
        pair_shard = (mix(mix(pair_context, 43) ^ pair_word, 44) % U64(trie_shards)).astype(np.int64)
        deal = np.argsort(pair_shard, kind="stable")
        back = np.empty(len(deal), np.int64)
        back[deal] = np.arange(len(deal))
        self.pair_of = back[at_two]
        self.pair_context, self.pair_word = pair_context[deal], pair_word[deal]
        self.pair_train = np.bincount(self.pair_of, self.train[self.split], len(deal)).astype(np.int64)
        self.pair_edges = np.searchsorted(pair_shard[deal], np.arange(trie_shards + 1))


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score; `held_out` rows train nothing."""
    common.bound_batches(docs.sparkSession)
    texts = docs.select("doc_id", held_out.alias("held"), "text")
    stored = blocks(texts)
    sums = stored.agg(
        F.sum("n_words"),
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, n: a + n) + F.size("n")),
        F.sum(F.size(F.filter("held", lambda h: ~h))),
    ).first()
    n_words, n_tokens, n_train_texts = (int(x or 0) for x in sums)
    word_shards, trie_shards = 1 + n_words // SHARD_WORDS, 1 + n_tokens // SHARD_TRIGRAMS
    answers = word_answers(stored, word_shards)
    totals = [unpacked(r.a) for r in answers.where("block = -1").select("a").collect()]  # two numbers per shard
    total = int(sum(int(t[0]) for t in totals)) + n_train_texts
    kinds = int(sum(int(t[1]) for t in totals)) + (n_train_texts > 0)
    whole = total + ADD * (kinds + 1)
    answers = answers.where("block >= 0").withColumn("level", F.lit(1))
    grouped = stored.groupBy("block")

    def ask(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows.iloc[0], known, word_shards, trie_shards, total, n_train_texts)
        out = []
        for s, (a, b) in enumerate(zip(block.edges, block.edges[1:])):
            if b > a:
                out.append((rows["block"].iloc[0], s, *(packed(x[a:b]) for x in (block.key, block.before, block.word, block.train))))
        for s, (a, b) in enumerate(zip(block.pair_edges, block.pair_edges[1:])):
            if b > a:
                context, word, train = (packed(x[a:b]) for x in (block.pair_context, block.pair_word, block.pair_train))
                out.append((rows["block"].iloc[0], trie_shards + s, context, b"", word, train))
        return pd.DataFrame(out, columns=["block", "shard", "key", "before", "word", "train"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["shard"].iloc[0] >= trie_shards:  # pairs of split contexts
            asked = [[unpacked(x) for x in frame[c]] for c in ("key", "word", "train")]
            counts = np.split(pair_counts(*map(np.concatenate, asked)), np.cumsum([len(x) for x in asked[0]])[:-1])
            return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "a": [packed(x) for x in counts], "b": b""})
        # all blocks are answered together, so every run of a level is opened once
        asked = [[unpacked(x) for x in frame[c]] for c in ("key", "before", "word", "train")]
        edges = np.cumsum([len(x) for x in asked[0]])[:-1]
        key, before, word, train = (np.concatenate(x) for x in asked)
        levels = build(key, before, word, train)
        with tempfile.TemporaryFile() as file:
            levels = Levels.mapped(file, levels.save(file))
            found = [np.split(codes(x), edges) for x in look_up(levels, key, before, word, (key & U64(SPLIT)) > 0)]
            del levels
        out = list(zip(*([packed(x) for x in part] for part in found)))
        return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "a": [a for a, _ in out], "b": [b for _, b in out]})

    def score(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        first, later = known[known["level"] == 1], known[known["level"] == 2].sort_values("shard")
        block = Block(rows.iloc[0], first, word_shards, trie_shards, total, n_train_texts)
        pairs, later = later[later["shard"] >= trie_shards], later[later["shard"] < trie_shards]
        part, rest = (parts(np.concatenate([unpacked(x) for x in later[c]])) for c in ("a", "b"))
        if len(pairs):
            of_pair = np.concatenate([unpacked(x) for x in pairs["a"]]).astype(np.float64)[block.pair_of]
            part[block.split] += rest[block.split] * of_pair / (block.split_count + M2)
            rest[block.split] *= M2 / (block.split_count + M2)
        count = np.r_[block.count, 0, n_train_texts]  # of words, begin and end
        plain = ((count + ADD) / whole)[block.token]
        p = part[block.inverse] + rest[block.inverse] * plain
        n = len(block.n)
        return pd.DataFrame(
            {
                "doc_id": pd.array(block.doc_ids, dtype="Int64"),
                "held_out": block.held,
                "n_tokens": block.n + 1,
                "n_known": np.bincount(block.text, count[block.token] > 0, n).astype(np.int64),
                "train_tokens": total,
                "base_score": np.bincount(block.text, np.log10(plain), n),
                "score": np.bincount(block.text, np.log10(p), n),
            }
        )

    trigrams = grouped.cogroup(answers.groupBy("block")).applyInPandas(
        ask, "block long, shard long, key binary, before binary, word binary, train binary"
    )
    found = trigrams.groupBy("shard").applyInPandas(answer, "block long, shard long, a binary, b binary")
    known = answers.unionByName(found.withColumn("level", F.lit(2)))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return grouped.cogroup(known.groupBy("block")).applyInPandas(score, schema)


def held_out_tenth(key: Column) -> Column:
    """crc32 of the id as text, modulo 10, is 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 10 == 0


def op1_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.read_table(spark, folder, "documents")
    return scores(docs, held_out_tenth(F.col("doc_id")))
