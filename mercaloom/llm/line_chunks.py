"""Line dedup by content-defined chunks: the lines of a text are cut where a rolling hash of two neighbouring lines says so.

What is judged is the pair of neighbouring lines: a pair goes if it stood before ("before" is by document id, then
text, then place) at a place that it does not overlap, and a line goes if it lies in a pair that goes. So a repeated
passage of two or more lines goes whole, wherever it stands and whatever stands around it; its first place keeps it.

A chunk is a run of pairs, two lines or more. Its ends are chosen by the hash of two lines only, so an inserted or lost
line moves no boundary beyond its own; chunks share a line with the next, so every pair lies in one chunk. Equal chunks
are one content, found by md5 in one narrow shuffle, and pairs are met once per content, not once per copy: a passage
in a million documents sends its pairs once. What a content's pairs have met then returns to the chunk's copies, so
matched chunks are extended, and unmatched ones searched, pair by pair. The bytes of the pairs that match are compared,
and a pair whose bytes differ from others of its hash stays. A chunk ends after `MOST_PAIRS` at the latest, as a text
may have no boundary; no pair is lost by that. DataFrame functions only.

Null and empty texts are one empty line and stay empty; a single repeated line stays; two blank lines are no pair; rows
equal in id and text are one document and keep what one of them keeps; a null id comes first; an empty table gives no
rows. All columns are returned, with the kept lines in `text`; input columns named as the two counts are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LINES_PER_CHUNK = 4
MOST_PAIRS = 64
FACTOR = 31
PLACES_PER_ROW = 4
NOT_BLANK = r"[^ \t\n\x0B\f\r]"
KEY = ["_id", "_row"]


def _with_lines(docs: DataFrame) -> DataFrame:
    # the explode of one element is a border: behind it the lines are a value, not an expression to repeat
    return docs.select("*", F.explode(F.array(F.split("text", "\n", -1))).alias("_lines"))


def _pair(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("\n"), b)


def chunks_of(texts: DataFrame) -> DataFrame:
    """Per chunk its document's key, `at` (its first line), `sum` and `pairs`, the md5 of each pair (null: blank)."""
    n_pairs = F.size("_lines") - 1
    neighbours = lambda c, f: F.zip_with(F.slice(c, 1, n_pairs), F.slice(c, 2, n_pairs), f)
    number = lambda line: F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")
    hashed = _with_lines(texts).where(n_pairs > 0)
    hashed = hashed.select("*", F.explode(F.array(F.transform("_lines", number))).alias("_hashes"))
    cuts = neighbours("_hashes", lambda a, b: (a * FACTOR + b) % LINES_PER_CHUNK == 0)
    ends = F.filter(F.transform(cuts, lambda cut, i: F.when(cut, i)), lambda i: i.isNotNull())
    ends = F.array_union(ends, F.array(n_pairs - 1))
    sums = neighbours("_lines", lambda a, b: F.when(_pair(a, b).rlike(NOT_BLANK), F.unhex(F.md5(_pair(a, b)))))
    cut = hashed.select("*", F.explode(F.array(F.struct(ends.alias("ends"), sums.alias("sums")))).alias("_cut"))
    ends = F.col("_cut.ends")
    starts = F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: e + 1))

    def parts(start: Column, end: Column) -> Column:
        place = lambda at: F.struct(at.alias("at"), F.least(at + F.lit(MOST_PAIRS - 1), end).alias("to"))
        return F.transform(F.sequence(start, end, F.lit(MOST_PAIRS)), place)

    def chunk(part: Column) -> Column:
        n = part["to"] - part["at"] + 1
        text = F.array_join(F.slice("_lines", part["at"] + 1, n + 1), "\n")
        return F.struct(part["at"].alias("at"), F.unhex(F.md5(text)).alias("sum"), F.slice("_cut.sums", part["at"] + 1, n).alias("pairs"))

    chunks = F.transform(F.flatten(F.zip_with(starts, ends, parts)), chunk)
    return cut.select(*KEY, F.explode(chunks).alias("chunk")).select(*KEY, "chunk.*")


def repeated_pairs(texts: DataFrame) -> DataFrame:
    """Every place of a pair that stands at two or more: document key, `at`, the pair's `sum` and its `first` place."""
    found = common.store(chunks_of(texts), "line-chunks")
    contents = found.groupBy("sum").agg(F.count("*").alias("copies"), F.min(F.struct(*KEY, "at", "pairs")).alias("one"))
    inside = contents.select("sum", "copies", "one", F.posexplode("one.pairs").alias("step", "pair")).where(F.col("pair").isNotNull())
    place = F.struct(*(F.col(f"one.{c}").alias(c) for c in KEY), (F.col("one.at") + F.col("step")).alias("at"))
    inside = common.store(inside.select("sum", "copies", "step", "pair", place.alias("place")), "line-contents")
    by_pair = inside.groupBy("pair").agg(
        F.sum("copies").alias("places"), F.count("*").alias("met"), F.min("place").alias("first")
    )
    by_pair = by_pair.where("places > 1").select("pair", "met", "first")
    known = common.join_counted(inside.select("sum", "copies", "step", "pair"), by_pair, "pair", "met", inside.count())
    known = known.where(F.col("met").isNotNull()).groupBy("sum").agg(
        F.max("copies").alias("copies"), F.collect_list(F.struct("step", "pair", "first")).alias("known")
    )
    known = common.store(known, "line-known")
    # a row of `known` holds MOST_PAIRS pairs at most, so its hot rows are small
    copies = common.join_counted(found.select(*KEY, "at", "sum"), known, "sum", "copies", found.count())
    pairs = copies.where(F.col("copies").isNotNull()).select(*KEY, "at", F.explode("known").alias("pair"))
    pairs = pairs.select(*KEY, (F.col("at") + F.col("pair.step")).alias("at"), F.col("pair.pair").alias("sum"), "pair.first")
    return common.store(pairs, "line-repeats")


def removed_pairs(docs: DataFrame) -> tuple[DataFrame, int]:
    """Per document key the first lines of the pairs to remove, and a bound on the entries to broadcast."""
    texts = docs.select(*KEY, "text")
    repeated = repeated_pairs(texts)
    places = repeated.groupBy(*KEY).agg(F.collect_set(F.struct("at", "sum")).alias("places"))
    places = common.store(places, "line-places")
    # a row of places is narrow: a key and some numbers and hashes, counted in fours
    entries = max(places.count(), repeated.count() // PLACES_PER_ROW)
    matched = _with_lines(_beside(texts, places, entries, "inner"))
    bytes_ = F.transform(
        "places", lambda p: F.struct(p["sum"].alias("sum"), _pair(F.get("_lines", p["at"]), F.get("_lines", p["at"] + 1)).alias("bytes"))
    )
    bytes_of = matched.select(F.explode(bytes_).alias("pair")).groupBy(F.col("pair.sum").alias("sum"))
    differ = bytes_of.agg(F.min("pair.bytes").alias("a"), F.max("pair.bytes").alias("b")).where("a != b").select("sum")
    overlaps = (F.struct(*KEY) == F.struct(*(F.col(f"first.{c}").alias(c) for c in KEY))) & (F.col("at") <= F.col("first.at") + 1)
    later = repeated.where(~overlaps).join(differ, "sum", "left_anti")
    return later.groupBy(*KEY).agg(F.collect_set("at").alias("_removed")), entries


def _beside(docs: DataFrame, places: DataFrame, entries: int, how: str) -> DataFrame:
    """Documents with their row of `places`, which is broadcast if it holds few enough entries in all."""
    return docs.join(F.broadcast(places) if entries <= common.BROADCAST_ROWS else places, KEY, how)


def _keyed(docs: DataFrame, n_lines: str, n_removed: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their key, and what their columns are called here."""
    names = [c for c in docs.columns if c not in (n_lines, n_removed)]
    renamed = {c: f"_column_{i}" for i, c in enumerate(names)}  # no input name can meet one of the names used here
    keyed = docs.select(
        *(F.col(f"`{c}`").alias(new) for c, new in renamed.items() if c != "text"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long")).alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row"),
    )
    return keyed, renamed


def dedup_lines(docs: DataFrame, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """The documents without the lines of pairs that stood before, and how many lines they had and lost."""
    keyed, renamed = _keyed(docs, n_lines, n_removed)
    joined = _with_lines(_beside(keyed, *removed_pairs(keyed), "left"))
    n = F.size("_lines")
    gone = F.concat("_removed", F.transform("_removed", lambda i: i + 1))
    stays = F.array_except(F.sequence(F.lit(0), n - 1), gone)  # by hash, in order
    kept = F.when(F.col("_removed").isNull(), F.col("_lines")).otherwise(F.transform(stays, lambda i: F.get("_lines", i)))
    counted = joined.select("*", F.explode(F.array(kept)).alias("_kept"))
    return counted.select(
        *(F.array_join("_kept", "\n").alias(c) if c == "text" else F.col(new).alias(c) for c, new in renamed.items()),
        n.cast("long").alias(n_lines),
        (n - F.size("_kept")).cast("long").alias(n_removed),
    )


def op4_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(common.read_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = f"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
    from documents
), pairs as (
    select *, line || chr(10) || lead(line) over (partition by doc_id order by i) as pair from lines
), firsts as (
    select pair, min((doc_id, i)) as place from pairs where regexp_matches(pair, '{NOT_BLANK}') group by pair
), judged as (
    select p.doc_id, p.i, p.line,
        coalesce((p.doc_id, p.i) != f.place and not (p.doc_id = f.place[1] and p.i <= f.place[2] + 1), false) as goes
    from pairs p left join firsts f using (pair)
), kept as (
    select *, not goes and not lag(goes, 1, false) over (partition by doc_id order by i) as stays from judged
)
select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_removed,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (stays), '')) as kept_sha256
from kept group by doc_id
"""
