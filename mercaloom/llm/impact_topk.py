"""Exact top-k inner-product search over an impact-ordered index, score at a time.

The rows are dealt into blocks; in a block every dimension has its postings in the order of their values, cut into
segments. For a query the impact of a segment is the most that it adds to a score above the dimension's least. The
segments of the highest impacts add up in accumulators, whose best rows are scored exactly in whole numbers: the k-th best
such score is a bound from below. Then the dimensions' whole lists, also kept in row order so that they add up as vectors,
are taken by descending impact. A row's score is at most its accumulator and what the lists not taken can add: the
sum of their own highest impacts, or the product of the norms (about the block's mean) of what is left of the query and of
the row, whichever is less, and a slack for what floating sums can err. Rows that can't reach the bound leave, which
proves them out; the bound rises with exact scores of the best left; those that are left when they are few, or when all
lists are taken, are scored exactly. Vectors so large that a score could leave 64 bits are refused with an error.

Queries meet all rows block by block; the best k of each block are merged by a window, which Spark limits before the
shuffle. So the work grows with queries times rows, however much is proven out; a task holds a block and a chunk of queries.
Vectors that are null, empty or hold null or non-finite parts take no part; vectors meet those of their own
length; a row is not its own result, but another row of its id can be; rows that repeat are rows, and queries, of their
own; rows with a null id take no part; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TOP = 20
SCALE = 64
EVERY = 20
BLOCK_ROWS = 16_384
QUERY_ROWS = 16_384
FEW_QUERIES = 1024  # a chunk has no fewer to keep more tasks busy
SEGMENTS = 32
FIRST_SEGMENTS = 16
STEP = 8  # dimensions
REACH = 0.5  # of the bound: what may be left to add at the first test
SPARSE = 4  # rows leave when at most one in so many is left
LARGEST = 1 << 63


class Block:
    """The impact-ordered index of one block of whole-number vectors; `rows` tells rows of equal ids apart."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.vectors, self.rows = ids, vectors, ids if rows is None else rows
        n, dims = vectors.shape
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        values = np.take_along_axis(vectors.T, self.order, 1)
        self.values = values.astype(np.float64)
        self.low, self.high = values[:, 0].astype(np.float64), values[:, -1].astype(np.float64)
        self.cuts = np.unique(np.linspace(0, n, min(SEGMENTS, n) + 1).astype(np.int64))
        self.seg_low, self.seg_high = self.values[:, self.cuts[:-1]], self.values[:, self.cuts[1:] - 1]
        self.centre = np.rint(vectors.mean(0))
        apart = vectors - self.centre
        self.columns = np.ascontiguousarray(apart.T, np.float32)
        self.norms = (np.sqrt((apart**2).sum(1)) * (1 + 2e-6)).astype(np.float32)
        self.norm, self.spread = float(self.norms.mean()), apart.std(0)

    def strongest(self, weight: np.ndarray, top: int) -> np.ndarray:
        """The best rows by what the segments of the highest impacts add up to."""
        up = weight >= 0
        least = np.where(up, weight * self.low, weight * self.high)  # of each dimension
        impact = np.where(up[:, None], weight[:, None] * self.seg_high, weight[:, None] * self.seg_low) - least[:, None]
        limit = np.partition(impact, max(0, impact.size - FIRST_SEGMENTS), None)[max(0, impact.size - FIRST_SEGMENTS)]
        reach = (impact >= limit).sum(1)  # a run of segments: at the upper end, or the lower for negative weights
        rows, adds = [], []
        for d in np.flatnonzero(reach):
            run = slice(self.cuts[-1 - reach[d]], None) if up[d] else slice(0, self.cuts[reach[d]])
            rows.append(self.order[d, run])
            adds.append(weight[d] * self.values[d, run] - least[d])
        sums = np.bincount(np.concatenate(rows), np.concatenate(adds), len(self.ids))
        return np.argpartition(-sums, min(top, len(sums) - 1))[: top + 1]

    def floor(self, rows: np.ndarray, own: int, query: np.ndarray, top: int) -> float:
        """The least of the best exact scores of some rows, if they are as many."""
        exact = self.vectors[rows[self.rows[rows] != own]] @ query
        return float(np.partition(exact, len(exact) - top)[len(exact) - top]) if len(exact) >= top else -np.inf

    def search(self, own: int, query: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best rows but the query's own, ties to the smaller id."""
        weight = query.astype(np.float64)
        largest = np.maximum(np.abs(self.low), np.abs(self.high)) * np.abs(weight)
        if largest.sum() >= LARGEST * 0.99:
            raise ValueError("a score can leave 64 bits")
        slack = largest.sum() * (len(weight) + 8) * 2.0**-21
        floor = self.floor(self.strongest(weight, top), own, query, top)
        base = weight @ self.centre
        dims = np.argsort(-np.abs(weight) * self.spread, kind="stable")
        most = np.maximum(weight * (self.low - self.centre), weight * (self.high - self.centre))[dims]
        left = np.append(np.cumsum(most[::-1])[::-1], 0)  # what the lists from each on can add
        norm = np.append(np.sqrt(np.cumsum((weight[dims] ** 2)[::-1])[::-1]), 0)
        likely = math.sqrt(2 * math.log(max(2, len(self.ids) / top))) * np.linalg.norm(weight * self.spread)  # of rows without order
        done = int(np.argmax(norm * self.norm <= REACH * max(floor - base, likely)))  # before, too few could leave
        weight = weight[dims].astype(np.float32)
        sums, norms, rivals = weight[:done] @ self.columns[dims[:done]], self.norms, np.arange(len(self.ids))
        while True:
            best = rivals[np.argpartition(-sums, min(top, len(sums) - 1))[: top + 1]]
            floor = max(floor, self.floor(best, own, query, top))
            bound = sums + np.minimum(norms * np.float32(norm[done]), np.float32(left[done]))
            stay = np.flatnonzero(bound >= floor - base - slack)
            if done == len(dims) or len(stay) <= 4 * top:
                rivals = rivals[stay]
                break
            if len(stay) * SPARSE <= len(self.ids):
                sums, norms, rivals = sums[stay], norms[stay], rivals[stay]
            taken = dims[done : done + STEP]
            added = self.columns[taken] if len(rivals) == len(self.ids) else self.columns[taken[:, None], rivals]
            sums = sums + weight[done : done + STEP] @ added
            done += len(taken)
        rivals = rivals[self.rows[rivals] != own]
        scores = self.vectors[rivals] @ query
        order = np.lexsort((self.ids[rivals], -scores))[:top]
        return self.ids[rivals][order], scores[order]


def whole_numbers(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id and `v`, the floors of the scaled parts, of the rows whose vector is complete and finite."""
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(sound).select("vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def top_k(rows: DataFrame, vector: str = "embedding", top: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the best rows of each row whose id is divisible by `every`."""
    points = whole_numbers(rows.where("vec_id is not null"), vector).withColumn("dim", F.size("v"))
    points = common.store(points.withColumn("row", F.monotonically_increasing_id()), "topk")
    queries = points.where(F.col("vec_id") % every == 0)
    blocks = -(-points.count() // BLOCK_ROWS) or 1
    n_queries = queries.count()
    busy = min(-(-n_queries // FEW_QUERIES), -(-common.shuffle_parts(rows.sparkSession) // blocks))
    chunks = max(-(-n_queries // QUERY_ROWS), busy, 1)
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("v", "row"), F.lit(chunks)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.select("dim", own.alias("block"), all_of(chunks).alias("chunk"), "vec_id", "row", "v")
    right = queries.select("dim", all_of(blocks).alias("block"), chunk.alias("chunk"), "vec_id", "row", "v")

    def search(frame: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not (len(frame) and len(asked)):
            return pd.DataFrame({c: [] for c in ("query_id", "query", "vec_id", "score")}, dtype="int64")
        block = Block(frame["vec_id"].to_numpy(), np.stack(frame["v"].to_numpy()).astype(np.int64), frame["row"].to_numpy())
        found = [block.search(row, np.asarray(v, np.int64), top) for row, v in zip(asked["row"], asked["v"])]
        sizes = [len(ids) for ids, _ in found]
        by_query = {"query_id": asked["vec_id"].to_numpy().repeat(sizes), "query": asked["row"].to_numpy().repeat(sizes)}
        ids, scores = map(np.concatenate, zip(*found))
        return pd.DataFrame(by_query | {"vec_id": ids, "score": scores})

    schema = "query_id long, query long, vec_id long, score long"
    keys = ("dim", "block", "chunk")  # a group is short to send and long to search, so few share a task
    left, right = (side.repartition(blocks * chunks, *keys).groupBy(*keys) for side in (left, right))
    met = left.cogroup(right).applyInPandas(search, schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_impact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(common.read_table(spark, folder, "embeddings"))


OP10_SQL = f"""
with points as (
    select vec_id, row_number() over () as place, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, q.place, p.vec_id, list_dot_product(q.v::double[], p.v::double[])::bigint as score
    from points q join points p on q.place != p.place and len(q.v) = len(p.v) where q.vec_id % {EVERY} = 0
), ranked as (
    select *, row_number() over (partition by place order by score desc, vec_id)::integer as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= {TOP}
"""
