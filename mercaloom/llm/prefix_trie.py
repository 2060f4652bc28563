"""The prefix trie of conversations, with subtree totals by time-forward processing.

Conversations that start with the same turns share nodes; a node is known by a hash of its turns and named by its
smallest member and its depth. A node's parent has a member that is smaller or the same, so in the order of (smallest
member, depth) every parent stands before its children. Ranges of that order, cut by Spark's range partitioning, are the
shards; a conversation longer than a shard runs through several.

Totals (childless nodes, saved tokens) go up in three steps:

1. Within a shard: its nodes are sorted externally in reverse level order, the deepest first; each takes the totals that its
   children have left for it in a priority queue, which spills its later half to scratch files, and leaves its own for
   its parent. What goes to a parent in an earlier shard leaves the task, added up per parent.
2. Across shard roots: each such parent passes what it got to the parent above its own shard's root. The sums along
   these steps are found by doubling, so their number of rounds is the logarithm of the longest way through shards.
3. Within a shard again, now with the final totals from later shards entering at their nodes.

A turn is hashed to 120 bits of md5 with its position, role and text; a node's hash combines those of its turns, so it is
found by two sums in blocks of `SCAN_ROWS` turns, however long one conversation is. A conversation's turns are
numbered in order by `grouped_row_number`, which spreads conversations that hold a large share of all turns.

Turns are in the order of `turn` (null first), then role and text; null role or text is empty. Rows that repeat are turns;
rows with a null conv_id belong to no conversation and are not read. `conv_id % 5` takes the sign of conv_id. An empty
table gives no rows, not even a root. Other columns are not read. `ends_sha256` follows a text of all ids that end in a
node; it is hashed in order as rows stream by, and no task holds them.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import grouped_row_number
from ..operators.skew import find_hot_keys
from . import common

FAMILY, HEAD_TURNS = 5, 9
SCAN_ROWS = 4096
QUEUE_ITEMS = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


class SpillingQueue:
    """A priority queue of tuples of five 64-bit numbers, smallest first, that holds at most `limit` of them in memory.

    When full it writes the later half as a sorted run to a scratch file of the task, which goes when it is closed.
    """

    RECORD = struct.Struct("<5q")
    READ = 4096

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.runs = max(2, limit), [], []

    def push(self, item: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        file = tempfile.TemporaryFile()
        for item in self.heap[half:]:
            file.write(self.RECORD.pack(*item))
        del self.heap[half:]
        file.seek(0)
        run = self._items(file)
        heapq.heappush(self.runs, (next(run), len(self.runs), run))

    def _items(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while data := file.read(self.RECORD.size * self.READ):
                yield from self.RECORD.iter_unpack(data)

    def pop_up_to(self, key: tuple[int, int]) -> Iterator[tuple[int, ...]]:
        """All items whose first two numbers are `key`; none before it may be left."""
        while True:
            in_heap = bool(self.heap) and self.heap[0][:2] == key
            if in_heap and not (self.runs and self.runs[0][0] < self.heap[0]):
                yield heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:2] == key:
                item, number, run = self.runs[0]
                following = next(run, None)
                if following is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (following, number, run))
                yield item
            else:
                return


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from its family's first."""
    return F.crc32(conv_id.cast("string")) % HEAD_TURNS


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (`conv_id`), and the rebuilt turns as (conv_id, depth, x1, x2, size): hashes of the turn at its
    depth and the bytes of its text."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    hot = find_hot_keys(turns, "conv_id")["conv_id"]
    numbered = grouped_row_number(turns, "place", "conv_id", "turn", "role", "text", hot=hot)
    numbered = common.store(
        numbered.select(
            "conv_id",
            F.col("place").cast("long").alias("place"),
            F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("said"),
            F.octet_length("text").cast("long").alias("size"),
        ),
        "trie-turns",
    )
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = (  # HEAD_TURNS - 1 turns each
        numbered.where((F.col("place") < HEAD_TURNS) & (F.col("conv_id") % FAMILY == 0))
        .groupBy(F.col("conv_id").alias("first"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "said", "size"))).alias("head"))
    )
    taken = F.least(F.coalesce(F.size("head"), F.lit(0)), head_turns(F.col("conv_id"))).cast("int")
    convs = sizes.withColumn("first", first).join(heads, "first", "left")
    convs = convs.select("conv_id", "n_turns", F.when(F.col("head").isNull(), 0).otherwise(taken).cast("int").alias("taken"), "head")
    convs = common.store(convs, "trie-conversations")
    given = convs.where("taken > 0").select("conv_id", F.explode(F.slice("head", F.lit(1), F.col("taken"))).alias("t"))
    given = given.select("conv_id", F.col("t.place").alias("depth"), "t.said", "t.size")
    # only a head shorter than asked for moves a conversation's own turns
    moved = convs.select("conv_id", "n_turns", (F.col("taken") - head_turns(F.col("conv_id"))).alias("by"))
    own = numbered.where(F.col("place") > head_turns(F.col("conv_id")))
    total = convs.agg(F.sum("n_turns")).first()[0] or 0
    own = common.join_counted(own, moved, "conv_id", "n_turns", total)
    own = own.select("conv_id", (F.col("place") + F.col("by")).alias("depth"), "said", "size")
    turn = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "said"))

    def part(at: int) -> Column:
        return F.conv(F.substring(turn, at, 15), 16, 10).cast("long")

    both = given.unionByName(own).select("conv_id", "depth", part(1).alias("x1"), part(17).alias("x2"), "size")
    return convs.select("conv_id"), both


def prefixes(turns: DataFrame) -> DataFrame:
    """Every rebuilt turn with the hashes of the turns up to it (p1, p2) and before it (q1, q2)."""
    block = F.col("depth").cast("long").bitwiseAND(-SCAN_ROWS).alias("block")
    turns = turns.withColumn("block", block)
    sums = [F.bit_xor(f"x{i}").alias(f"b{i}") for i in (1, 2)]
    # one row per block of turns; only conversations of several blocks matter
    blocks = turns.groupBy("conv_id", "block").agg(*sums)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("conv_id", "block", *(F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)))
    offsets = offsets.where("block > 0")
    up_to = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    found = turns.join(offsets, ["conv_id", "block"], "left")
    for i in (1, 2):
        found = found.withColumn(f"p{i}", F.bit_xor(f"x{i}").over(up_to).bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))))
    return found.select("conv_id", "depth", "p1", "p2", *(F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)), "size")


def hash_of_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the ids in order, joined by commas, hashed as they stream by."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            nodes, hashes = [], []
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if node != now:
                    if now is not None:
                        nodes.append(now)
                        hashes.append(sha.hexdigest())
                    now, sha = node, hashlib.sha256(b"%d" % conv)
                else:
                    sha.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    dealt = ends.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    return dealt.mapInArrow(digest, "node binary, ends_sha256 string")


def _node(one: str, two: str) -> Column:
    """The two hashes as one binary key."""
    return F.unhex(F.concat(F.lpad(F.hex(one), 16, "0"), F.lpad(F.hex(two), 16, "0")))


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, size (bytes of the last text), ends_sha256."""
    convs, turns = rebuilt_turns(conversations)
    rows = common.store(prefixes(turns), "trie-rows")
    # no turns: the root, with nothing above
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")
    start = convs.select("conv_id", *(zero.alias(c) for c in ("depth", "p1", "p2", "size")), *(nothing.alias(c) for c in ("q1", "q2")))
    members = rows.unionByName(start)
    nodes = members.groupBy("p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(c).alias(c) for c in ("depth", "q1", "q2", "size"))
    )
    nodes = nodes.select(_node("p1", "p2").alias("node"), "conv_id", "depth", _node("q1", "q2").alias("above"), "size", "n_convs")
    nodes = common.store(nodes, "trie-members")
    children = nodes.where("above is not null").groupBy(F.col("above").alias("node")).agg(F.count("*").alias("n_children"))
    last = members.groupBy("conv_id").agg(*(F.max_by(p, "depth").alias(p) for p in ("p1", "p2")))
    last = last.select("conv_id", _node("p1", "p2").alias("node"))
    nodes = nodes.join(children, "node", "left").join(hash_of_ends(last), "node", "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = common.store(nodes, "trie-nodes")
    parents = nodes.where("n_children > 0").select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = nodes.select(F.col("n_children").alias("children"), *(c for c in nodes.columns if c != "n_children"))
    total = max(1, nodes.where("above is not null").count())
    return common.join_counted(below, parents, "above", "n_children", total).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), "size",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


SHARDED = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "size", "ends_sha256", "shard"


def shard(nodes: DataFrame, parts: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The nodes with their shard, stored, and the first (conv_id, depth) of each shard; one pair per shard."""
    ranged = nodes.repartitionByRange(parts, "conv_id", "depth").withColumn("shard", F.spark_partition_id())
    ranged = common.store(ranged.select(*SHARDED), "trie-shards")
    found = ranged.groupBy("shard").agg(F.min(F.struct("conv_id", "depth")).alias("top")).collect()
    known = {r.shard: tuple(r.top) for r in found}
    firsts: list[tuple[int, int]] = []
    for number in range(max(known, default=-1), -1, -1):  # a shard without nodes begins where the next one does
        firsts.append(known.get(number) or firsts[-1])
    return ranged, firsts[::-1]


def _ascending(rows: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in rows:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


TOTALS = "conv_id long, depth long, shard int, n_leaves long, saved_tokens long"
BATCH = 10_000


def _time_forward(sharded: DataFrame, arriving: DataFrame | None, firsts: list[tuple[int, int]], upwards: bool) -> DataFrame:
    """One pass over all shards in reverse level order.

    `arriving` (conv_id, depth, shard, n_leaves, saved_tokens) enters at its nodes. `upwards`: returns what leaves the shards, as
    `TOTALS` of the parents it goes to; else the finished nodes.
    """
    limit = QUEUE_ITEMS
    columns = [*SHARDED, "n_leaves", "saved_tokens"]
    rows = sharded.withColumns({c: F.lit(None).cast("long") for c in ("n_leaves", "saved_tokens")})
    if upwards:  # hashes of ends stay at home
        rows = rows.withColumn("ends_sha256", F.lit(None).cast("string"))
    if arriving is not None:
        rows = rows.unionByName(arriving, allowMissingColumns=True)
    # what arrives stands before its node: it has no number of members
    placed = rows.repartitionById(len(firsts), "shard").sortWithinPartitions(
        "shard", F.desc("depth"), F.desc("conv_id"), F.asc_nulls_first("n_convs")
    )
    names = [x.split()[0] for x in (TOTALS if upwards else RESULT).split(", ")]
    types = [pa.int32() if c == "shard" else pa.string() if c == "ends_sha256" else pa.int64() for c in names]

    def pass_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, out, now = SpillingQueue(limit), [], None
        leaves_in = saved_in = 0

        def flush() -> pa.RecordBatch:
            lists = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(lists, types)], names)

        for conv, depth, parent, n_convs, n_children, size, ends, at, n_leaves, saved in _ascending(batches, columns):
            if at != now:
                now, first = at, firsts[at]
            if n_convs is None:
                leaves_in, saved_in = leaves_in + n_leaves, saved_in + saved
                continue
            saved = (n_convs - 1) * size + saved_in
            n_leaves = leaves_in if n_children else 1
            leaves_in = saved_in = 0
            for item in queue.pop_up_to((-depth, -conv)):
                n_leaves, saved = n_leaves + item[3], saved + item[4]
            if parent is not None and (parent, depth - 1) >= first:
                queue.push((1 - depth, -parent, -conv, n_leaves, saved))
            elif upwards and parent is not None:
                out.append((parent, depth - 1, bisect_right(firsts, (parent, depth - 1)) - 1, n_leaves, saved))
            if not upwards:
                out.append((conv, depth, parent, n_convs, n_children, n_leaves, saved, ends))
            if len(out) >= BATCH:
                yield flush()
        yield flush()

    return placed.mapInArrow(pass_up, TOTALS if upwards else RESULT)


def _exits(sharded: DataFrame, firsts: list[tuple[int, int]]) -> DataFrame:
    """For each conversation with nodes in a shard (`shard`, `conv_id`) where the way up leaves that shard: the node
    above the shard's root it comes to (`to_conv`, `to_depth`, `to_shard`), null above the trie's root."""
    tops = sharded.groupBy("shard", "conv_id").agg(F.min(F.struct("depth", "parent_conv_id")).alias("top"))
    tops = tops.select("shard", "conv_id", "top.*").repartitionById(len(firsts), "shard").sortWithinPartitions("shard", "conv_id")
    schema = "shard int, conv_id long, to_conv long, to_depth long, to_shard int"

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ways = None, {}
        for batch in batches:
            out = []
            for at, conv, depth, parent in _ascending(iter([batch]), ["shard", "conv_id", "depth", "parent_conv_id"]):
                if at != now:
                    now, ways = at, {}  # one entry per conversation of the shard
                if parent is None:
                    way = None, None, None
                elif (parent, depth - 1) >= firsts[at]:
                    way = ways[parent]
                else:
                    way = parent, depth - 1, bisect_right(firsts, (parent, depth - 1)) - 1
                ways[conv] = way
                out.append((at, conv, *way))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            lists = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(lists, types)], ["shard", "conv_id", "to_conv", "to_depth", "to_shard"])

    return tops.mapInArrow(leave, schema)


def across_shards(leaving: DataFrame, exits: DataFrame) -> DataFrame:
    """What arrives at each node from later shards in the end, from what arrives there from the shards next below.

    A target's pointer is the node above its shard's root. In round k every target adds the sums of the targets 2**k
    steps below and then points twice as far; without pointers it is done.
    """
    key = ["conv_id", "depth", "shard"]
    names = key + ["n_leaves", "saved_tokens"]
    sums = common.store(leaving.groupBy(*key).agg(*(F.sum(c).alias(c) for c in names[3:])), "trie-arriving")
    ways = sums.select(*key).join(exits, ["shard", "conv_id"]).where("to_conv is not null")
    ways = common.store(ways.select(*key, "to_conv", "to_depth", "to_shard"), "trie-ways")
    while not ways.isEmpty():
        carried = sums.join(ways, key).select(
            F.col("to_conv").alias("conv_id"), F.col("to_depth").alias("depth"), F.col("to_shard").alias("shard"), *names[3:]
        )
        sums = sums.unionByName(carried).groupBy(*key).agg(*(F.sum(c).alias(c) for c in names[3:]))
        sums = common.store(sums, "trie-arriving")
        onward = ways.select(*(F.col(c).alias(f"to_{c}".replace("conv_id", "conv")) for c in key), *(F.col(f"to_{c}").alias(f"far_{c}") for c in ("conv", "depth", "shard")))
        far = ways.join(onward, ["to_conv", "to_depth", "to_shard"])
        ways = common.store(far.select(*key, *(F.col(f"far_{c}").alias(f"to_{c}") for c in ("conv", "depth", "shard"))), "trie-ways")
    return sums


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations, with the totals of their subtrees."""
    spark = conversations.sparkSession
    sharded, firsts = shard(trie_nodes(conversations), shards or common.shuffle_parts(spark))
    if not firsts:
        return spark.createDataFrame([], RESULT)
    if len(firsts) == 1:
        return _time_forward(sharded, None, firsts, upwards=False)
    leaving = _time_forward(sharded, None, firsts, upwards=True)
    arriving = across_shards(leaving, _exits(sharded, firsts))
    return _time_forward(sharded, arriving, firsts, upwards=False)


# The reflected polynomial of crc32 and its start and end mask.
OP12_SQL = """
with ids as (select distinct conv_id from conversations where conv_id is not null),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
),
crcs as (
  select conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
           range(8 * length(conv_id::varchar)), lambda i: ((ord(substr(conv_id::varchar, (i // 8 + 1)::int, 1)) >> (i % 8)::int) & 1)::bigint)),
         lambda c, b: case when xor(c & 1, b) = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
  from ids
),
lists as (select conv_id, list({'role': role, 'text': text} order by place) as said from turns group by conv_id),
rebuilt as (
  select c.conv_id, coalesce(b.said[1:(c.crc % 9)::int], []) || coalesce(o.said[(c.crc % 9)::int + 1:], []) as said
  from crcs c join lists o on o.conv_id = c.conv_id left join lists b on b.conv_id = c.conv_id - c.conv_id % 5
),
members as (select conv_id, said, d as depth, said[1:d::int] as path from rebuilt, unnest(range(len(said) + 1)) as t(d)),
nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(said) = depth), '')) as ends_sha256,
         case when depth > 0 then (count(*) - 1) * strlen(path[depth::int].text) else 0 end as saved
  from members group by path, depth
),
linked as (
  select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and c.path[1:n.depth::int] = n.path) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth::int - 1]
),
ups as (select l.saved, l.n_children, l.path[1:d::int] as path, d as depth from linked l, unnest(range(l.depth + 1)) as t(d)),
sums as (select path, depth, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens from ups group by path, depth)
select l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens::bigint as saved_tokens, l.ends_sha256
from linked l join sums s on s.depth = l.depth and s.path = l.path
"""


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(common.read_table(spark, folder, "conversations"))
