"""Exact n-gram Jaccard join: count vectors in an R-tree bound the overlap of shingle sets, surviving pairs are verified.

A document's set is its distinct shingles, three words wide unless a caller asks for another width. Equal sets are one class; everything below is about classes.

Meeting. All shingles stand in one order, those of rarely used hash cells first; the cells' counts come from every
row. Sets with a Jaccard likeness of p share p of the larger set at least, so among the first n - ceil(p n) + 1 shingles
of each, in this order, there is one that both hold, and the pair meets there: no link is lost. Shingles of very common
passages come last, so documents that share no more than such a passage do not meet. The counts are 65,536 numbers
whatever the input's size; they decide the order and nothing else.

Bounding. Per class the shingles are counted in 128 hash groups, a byte each. Who meets is packed into an R-tree of
these points; sum(min(a_g, b_g)) bounds the overlap, for a box with its upper corner, and must reach 0.9 / 1.9 of the
sizes. A byte that is full says nothing, so what holds two of them is always verified.

Verifying in rounds, so that a group of copies is never spelled out in pairs. First each class is tried, in up to
`LEADS` of its meetings, with the group's first, and in one of them with its neighbour in the tree's order. Then, in
`ROUNDS` searches of the same meetings, with the one of other components whose bound is best. After each round links
make components. The last search takes all meetings and gives all pairs that survive the bound and lie in different
components; boxes of the searcher's own component are skipped and groups of one component are not searched at all. Of
a pair's meetings the one of the smallest key names it: each class brings its first `MARKS` keys, and a pair that
shares a smaller one of them is left to that meeting. Verification intersects the sets themselves.

Shingles are 64-bit hashes. Null and empty texts have no shingles and no links; fewer than three words are one
shingle; equal texts are linked; rows of equal id are separate rows; a null id is last when the smallest id is sought;
an empty table gives no rows; other columns are not read. With another width, fewer words than that are one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import components
from .hashing import U64, mix, shingle_sets, sums_by_run

WIDTH = 3
PERCENT = 90
SLICE_BYTES = 512 << 10  # of texts whose shingles are made at once
GROUPS = 128
FULL = 255
CELLS = 1 << 16
NODE = 16
PIECE = 20_000  # a larger group of meeting classes is cut into pieces, each pair of pieces being searched
BUCKET_ROWS = 50_000
LEADS = 3  # meetings in which a class is tried with others in the first round
MARKS = 8
ROUNDS = 2


def enough(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether an overlap of sets of sizes a and b makes a link."""
    return 100 * overlap >= percent * (a + b - overlap)


def meeting_keys(
    hashes: np.ndarray, offsets: np.ndarray, percent: int = PERCENT, ranks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The shingles under which sets meet, and the number of the set of each; `ranks` orders the cells."""
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    cell = hashes >> U64(48)
    rank = cell if ranks is None else ranks.astype(U64)[cell.astype(np.int64)]
    value = (owner.astype(U64) << U64(44)) | (rank << U64(28)) | (mix(hashes, 11) >> U64(36))  # a batch has fewer than 2**20 rows
    order = np.argsort(value)
    value = value[order]
    # a smaller set has no partner but its equals
    first = np.where(sizes >= percent // (100 - percent), sizes + (-sizes * percent) // 100 + 1, 0)
    chosen = np.flatnonzero(first)
    last = np.zeros(len(sizes), U64)
    last[chosen] = value[offsets[:-1][chosen] + first[chosen] - 1]
    taken = (first[owner] > 0) & (value <= last[owner])  # all that tie with the last one, so ties need no order
    return hashes[order][taken], owner[taken]


def set_classes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number per set, the same for equal sets."""
    a, b = sums_by_run(mix(hashes, 21), offsets), sums_by_run(mix(hashes, 22), offsets)
    return mix(mix(a, 23) ^ b ^ mix(np.diff(offsets).astype(U64), 24), 25)


def count_vectors(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A byte per set and group; FULL stands for itself and for anything above."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    slot = doc * GROUPS + (mix(hashes, 31) >> U64(57)).astype(np.int64)
    return np.minimum(np.bincount(slot, minlength=n * GROUPS), FULL).reshape(n, GROUPS).astype(np.uint8)


def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most that sets of these counts can share."""
    least = np.minimum(a, b)
    return np.where((least == FULL).any(1), 1 << 40, least.sum(1, dtype=np.int64))


class Tree:
    """An R-tree over the count vectors of groups of meeting classes: one root per group, all built together.

    Points must be sorted by group, then size; each level packs runs of up to NODE neighbours of one group.
    """

    def __init__(self, group: np.ndarray, size: np.ndarray, counts: np.ndarray, part: np.ndarray):
        self.levels = [(group, size, counts, part, part, np.arange(len(group) + 1))]
        while True:
            g, low, high, p_low, p_high, _ = self.levels[-1]
            change = np.r_[True, g[1:] != g[:-1]]
            rank = np.arange(len(g)) - np.maximum.accumulate(np.where(change, np.arange(len(g)), 0))
            starts = np.flatnonzero(rank % NODE == 0)
            if len(starts) == len(g) and len(self.levels) > 1:
                break
            reduce = lambda f, x: f.reduceat(x, starts, axis=0)
            self.levels.append(
                (g[starts], reduce(np.minimum, low), reduce(np.maximum, high), reduce(np.minimum, p_low), reduce(np.maximum, p_high), np.r_[starts, len(g)])
            )
            if not (np.r_[self.levels[-1][0][1:] == self.levels[-1][0][:-1], False]).any():
                break

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs i > j of points of a group but different parts whose bound allows a link."""
        group, size, counts, part, _, _ = self.levels[0]
        roots = self.levels[-1][0]
        for at in range(0, len(group), 1024):
            query = np.arange(at, min(at + 1024, len(group)))
            node = np.searchsorted(roots, group[query])
            for level in range(len(self.levels) - 1, 0, -1):
                children = self.levels[level][5]
                n = children[node + 1] - children[node]
                query = np.repeat(query, n)
                child = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(children[node], n)
                _, low, high, p_low, p_high, below = self.levels[level - 1]
                first = child if level == 1 else self._first_point(level - 1, child)
                keep = (first < query) & ~((p_low[child] == part[query]) & (p_high[child] == part[query]))
                query, child = query[keep], child[keep]
                keep = np.zeros(len(query), bool)
                for k in range(0, len(query), 1 << 15):
                    q, c = query[k : k + (1 << 15)], child[k : k + (1 << 15)]
                    bound = bounds(counts[q], high[c])
                    keep[k : k + (1 << 15)] = enough(bound, size[q], low[c] if level > 1 else size[c], percent)
                query, node = query[keep], child[keep]
            if len(query):
                yield query, node

    def _first_point(self, level: int, node: np.ndarray) -> np.ndarray:
        for k in range(level, 0, -1):
            node = self.levels[k][5][node]
        return node


def class_table(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n_shingles, class and counts of every row, stored; and the order of the cells, the least used first."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(CELLS, np.int64)
        names = ["doc_id", "n_shingles", "class", "counts", "cells"]
        for batch in common.slices(batches, "text", SLICE_BYTES):
            hashes, offsets = shingle_sets(common.texts_of(batch), width)
            used += np.bincount((hashes >> U64(48)).astype(np.int64), minlength=CELLS)
            n, vectors = np.diff(offsets), count_vectors(hashes, offsets)
            classes = pa.array(set_classes(hashes, offsets).view(np.int64), mask=n == 0)
            columns = [batch.column("doc_id"), pa.array(n), classes, pa.array([v.tobytes() for v in vectors], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(n), pa.binary())], names)
        none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array([used.astype("<i8").tobytes()], pa.binary())], names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.column("cells"):
                used = np.frombuffer(cells.as_buffer(), "<i8")
                cell = np.flatnonzero(used)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(used[cell])], ["cell", "n"])

    schema = "doc_id long, n_shingles long, class long, counts binary, cells binary"
    stored = common.store(docs.mapInArrow(read, schema), "jaccard-sets")
    cells = stored.where("cells is not null").select("cells").mapInArrow(unpack, "cell int, n long")
    used = np.zeros(CELLS, np.int64)
    for cell, n in cells.groupBy("cell").agg(F.sum("n")).collect():  # at most CELLS rows
        used[cell] = n
    ranks = np.empty(CELLS, np.uint16)
    ranks[np.argsort(used, kind="stable")] = np.arange(CELLS, dtype=np.uint16)
    return stored.where("cells is null").drop("cells"), ranks


def meetings(docs: DataFrame, ranks: np.ndarray, percent: int, width: int = WIDTH) -> DataFrame:
    """(key, class) of every set; computed anew where it is needed, as that is cheaper than storing it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            hashes, offsets = shingle_sets(common.texts_of(batch), width)
            classes, (keys, owners) = set_classes(hashes, offsets), meeting_keys(hashes, offsets, percent, ranks)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(classes[owners].view(np.int64))], ["key", "class"])

    return docs.select("text").mapInArrow(read, "key long, class long")


def met_classes(docs: DataFrame, ranks: np.ndarray, percent: int, width: int, scratch: common.Scratch) -> DataFrame:
    """(key, class, n_met) of the keys that several classes hold; stored."""
    rows = meetings(docs, ranks, percent, width)
    busy = rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("n_met"))
    busy = scratch.store(busy.where("lo != hi").select("key", "n_met"), "jaccard-keys")
    total = busy.agg(F.sum("n_met")).first()[0] or 0
    return scratch.store(common.matches_counted(rows, busy, "key", "n_met", total).distinct(), "jaccard-met")


def first_keys(met: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(key, class, n_met, place) of the MARKS smallest keys of each class; stored."""
    place = F.row_number().over(Window.partitionBy("class").orderBy("key"))
    return scratch.store(met.withColumn("place", place).where(F.col("place") <= MARKS), "jaccard-first")


def best_partners(pairs: Iterator[tuple[np.ndarray, np.ndarray]], size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each point the one of its pairs whose bound is the largest part of the sizes, or -1."""
    best, score = np.full(len(size), -1), np.zeros(len(size))
    for i, j in pairs:
        now = np.concatenate([bounds(counts[i[k : k + (1 << 15)]], counts[j[k : k + (1 << 15)]]) for k in range(0, len(i), 1 << 15)])
        now = now / (size[i] + size[j])
        order = np.argsort(now, kind="stable")
        for x, y in ((i[order], j[order]), (j[order], i[order])):
            last = np.full(len(size), -1)
            last[x] = np.arange(len(x))  # the best comes last
            point = np.flatnonzero(last >= 0)
            point = point[now[order][last[point]] > score[point]]
            best[point], score[point] = y[last[point]], now[order][last[point]]
    return best


def _searched(met: DataFrame, classes: DataFrame, firsts: DataFrame | None, percent: int, best: bool = False) -> DataFrame:
    """Candidate links (a, b) among (key, class, n_met, part).

    With `firsts`, all survivors in different parts; with `best`, of these the best of each class in each group; else
    those of neighbours in the tree's order, where `place` is 1, and of the groups' firsts.
    """
    pairs = firsts is not None
    buckets = max(1, met.count() // BUCKET_ROWS)
    met = met.join(classes.select("class", F.col("n_shingles").alias("n"), "counts"), "class")
    pieces = F.ceil(F.col("n_met") / PIECE).cast("int")
    own = F.pmod("class", pieces).cast("int")
    if pairs:  # every pair of pieces of a large group meets once
        marks = firsts.groupBy("class").agg(F.array_sort(F.collect_list("key")).alias("marks"))  # MARKS keys at most
        met = met.join(marks, "class").withColumn("place", F.lit(0))
        piece = F.explode(F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.struct(F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi"))))
    else:
        met = met.withColumn("marks", F.lit(None).cast("array<long>"))
        piece = F.struct(own.alias("lo"), own.alias("hi"))
    placed = met.withColumn("piece", piece).withColumn("bucket", F.when(F.col("n_met") > PIECE, F.xxhash64("key", "piece")).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets))))
    placed = placed.select("bucket", F.xxhash64("key", "piece").alias("group"), "key", "class", "n", "counts", "part", "place", "marks")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        group, size = frame["group"].to_numpy(), frame["n"].to_numpy().astype(np.int64)
        counts = np.frombuffer(b"".join(frame["counts"]), np.uint8).reshape(-1, GROUPS)
        order = np.lexsort((frame["class"].to_numpy(), *counts.T[:4], size, group))
        group, size, counts = group[order], size[order], counts[order]
        name, part, place, key = (frame[c].to_numpy()[order] for c in ("class", "part", "place", "key"))
        found = []
        if pairs:
            marks = np.full((len(frame), MARKS), np.iinfo(np.int64).max)
            for row, own_marks in zip(marks, frame["marks"]):
                row[: len(own_marks)] = own_marks
            marks = marks[order]
            for i, j in Tree(group, size, counts, part).pairs(percent):
                for at in range(0, len(i), 1 << 13):
                    x, y = i[at : at + (1 << 13)], j[at : at + (1 << 13)]
                    mine = np.where(marks[x] < key[x][:, None], marks[x], np.iinfo(np.int64).min)
                    elsewhere = (mine[:, :, None] == marks[y][:, None, :]).any((1, 2))
                    found.append((x[~elsewhere], y[~elsewhere]))
        elif best:
            partner = best_partners(Tree(group, size, counts, part).pairs(percent), size, counts)
            found.append((np.flatnonzero(partner >= 0), partner[partner >= 0]))
        else:
            i = np.arange(len(group))
            first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], i, 0))
            for j, tried in ((first, i != first), (np.maximum(i - 1, first), (place == 1) & (i - 1 > first))):
                keep = tried & (name != name[j]) & enough(bounds(counts, counts[j]), size, size[j], percent)
                found.append((i[keep], j[keep]))
        a = np.concatenate([name[i] for i, _ in found] or [np.zeros(0, np.int64)])
        b = np.concatenate([name[j] for _, j in found] or [np.zeros(0, np.int64)])
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    return placed.groupBy("bucket").applyInPandas(search, "a long, b long")


def verified(candidates: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, width: int, scratch: common.Scratch) -> DataFrame:
    """The candidate pairs whose sets overlap enough."""
    candidates = scratch.store(candidates.distinct(), "jaccard-candidates")
    wanted = candidates.select(F.col("a").alias("class")).unionAll(candidates.select(F.col("b").alias("class"))).distinct()
    ids = scratch.store(classes.join(wanted, "class").select(F.col("first_id").alias("doc_id")).distinct(), "jaccard-ids")
    small = ids.count() <= common.BROADCAST_ROWS
    texts = docs.join(F.broadcast(ids) if small else ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            hashes, offsets = shingle_sets(common.texts_of(batch), width)
            sets = [hashes[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(set_classes(hashes, offsets).view(np.int64)), pa.array(sets, pa.binary())], ["class", "set"])

    sets = texts.mapInArrow(read, "class long, set binary")
    left = candidates.join(sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), U64) for s in (x, y))
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(enough(overlap, len(x), len(y), percent)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    return scratch.store(both.select("a", "b", "set_a", "set_b").mapInArrow(intersect, "a long, b long").distinct(), "jaccard-links")


def _classes(rows: DataFrame, scratch: common.Scratch) -> DataFrame:
    merged = rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("counts").alias("counts")
    )
    return scratch.store(merged, "jaccard-classes")


def _torn(met: DataFrame, links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """The rows of groups that several components meet in, with their component as `part`; stored."""
    parts = components(links, "jaccard-parts", scratch.store).select(F.col("node").alias("class"), "component")
    parted = met.join(parts, "class", "left").withColumn("part", F.coalesce("component", "class")).drop("component")
    parted = scratch.store(parted.drop("n_met"), "jaccard-parted")
    torn = parted.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n_met")).where("lo != hi")
    torn = scratch.store(torn.select("key", "n_met"), "jaccard-torn")
    return scratch.store(common.matches_counted(parted, torn, "key", "n_met", max(1, parted.count())), "jaccard-open")


def linked_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that a chain of links reaches."""
    common.bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows, ranks = class_table(docs, width)
    scratch = common.Scratch(docs.sparkSession)
    classes = _classes(rows, scratch)
    met = met_classes(docs, ranks, percent, width, scratch)
    firsts = first_keys(met, scratch)

    leads = firsts.where(F.col("place") <= LEADS)
    links = verified(_searched(leads.withColumn("part", F.lit(0)), classes, None, percent), docs, classes, percent, width, scratch)
    for _ in range(ROUNDS):
        more = _searched(_torn(leads, links, scratch), classes, None, percent, best=True)
        links = links.unionAll(verified(more, docs, classes, percent, width, scratch))
    more = verified(_searched(_torn(met, links, scratch), classes, firsts, percent), docs, classes, percent, width, scratch)

    parts = components(links.unionAll(more), "jaccard-parts", scratch.store).select(F.col("node").alias("class"), "component")
    named = classes.select("class", "first_id", "copies").join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = scratch.store(named, "jaccard-named")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    named = common.join_counted(named, smallest, "component", "n", max(1, named.count())).select("class", "copies", "component_id")
    named = common.store(named, "jaccard-ends")
    scratch.drop()
    out = common.join_counted(rows.drop("counts"), named, "class", "copies", max(1, rows.count()))
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def class_links(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """All links (a, b), a > b, between classes of equal sets, and the members (doc_id, class) of each class.

    The tree is searched over all classes, so links inside a component are found too; their number is that of the pairs.
    """
    common.bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows, ranks = class_table(docs, width)
    scratch = common.Scratch(docs.sparkSession)
    classes = _classes(rows, scratch)
    met = met_classes(docs, ranks, percent, width, scratch)
    found = _searched(met.withColumn("part", F.col("class")), classes, first_keys(met, scratch), percent)
    links = common.store(verified(found, docs, classes, percent, width, scratch), "jaccard-class-links")
    scratch.drop()
    return links, rows.where("class is not null").select("doc_id", "class")


def op6_jaccard_rtree(spark: SparkSession, folder: str) -> DataFrame:
    return linked_components(common.read_table(spark, folder, "documents"))
