"""CSV files as records with their numbers, read in splits although quoted texts may hold line breaks.

Whether a line begins inside a quoted text depends on all lines before it, but a line only maps "inside or not at its
start" to "inside or not at its end". First the lines of every split are counted. If there are quotes, a pass over the
lines that hold some works out each split's map, for both cases at once, and how many of its lines lie inside; a window over
these few rows gives every split its true start and the number of its first record. The last pass then knows its
records. Where each line is a record, it runs without Python. Records that end in a later split come out in pieces, at
most one per split, and are put together by (file, number).

All passes read the files through Spark in the same splits; splits that changed in between are an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import POSITION_BITS
from ..operators.storage import materialize

# One field of a record, quoted (a doubled quote stands for one) or not, and what follows it.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
_WHOLE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+", re.DOTALL)
_REST = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+', re.DOTALL)

# A record longer than this was never closed; it is shown by its start and rejected.
LONGEST_RECORD = 64 << 20
SHOWN = 1000

SPLIT = ("file", "start", "length")
RECORD = "file string, number long, place long, text string, whole boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted text is still open at the end of a line."""
    return (_REST if inside else _WHOLE).fullmatch(line) is None


def _lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    options = {"lineSep": "\n", **({"pathGlobFilter": pattern} if pattern else {})}
    text = F.regexp_replace("value", r"\r\z", "")
    return spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("line"),
        F.when(F.col("value").endswith("\r"), text).otherwise(F.col("value")).alias("text"),
    )


def _quoted() -> Column:
    return F.contains("text", F.lit('"'))


def _blank() -> Column:
    return F.trim("text") == ""


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """A batch cut where the split changes."""
    keys = [batch.column(c).dictionary_encode() for c in ("file", "start")]
    codes = [k.indices.to_numpy() for k in keys]
    changes = np.flatnonzero((codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])) + 1
    for a, b in zip([0, *changes], [*changes, batch.num_rows]):
        if a < b:
            yield tuple(batch.column(c)[int(a)].as_py() for c in SPLIT), batch.slice(a, b - a)


def _walk(quoted: list[int], lines: list[str], inside: bool, n: int) -> tuple[np.ndarray, bool]:
    """Whether each of n lines begins inside a quoted text; only lines with quotes can change that."""
    before = np.zeros(n, bool)
    start = 0
    for i, line in zip(quoted, lines):
        before[start : i + 1] = inside
        inside, start = ends_inside(line, inside), i + 1
    before[start:] = inside
    return before, inside


@dataclass(frozen=True)
class Starts:
    """Per split (`file`, `start`, `length`): whether it begins `inside` a quoted text, the number of records that begin
    before it in its file (`base`), and its first line. `lines_are_records` says that no other line is anything else."""

    splits: DataFrame
    lines_are_records: bool


def _maps(lines: DataFrame, tally: DataFrame) -> DataFrame:
    """What the splits with quotes or blank lines do: the state at their end and the records that begin in them, for a start
    outside and inside a quoted text. Only these lines travel to Python."""
    asked = lines.where(_quoted() | _blank()).join(F.broadcast(tally), list(SPLIT))
    asked = asked.select(*SPLIT, "line", "first_line", "n_lines", F.when(_quoted(), F.col("text")).alias("text"))
    schema = "file string, start long, length long, out_after boolean, in_after boolean, n_out long, n_in long"
    names = [x.split()[0] for x in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, other, at, end = None, [False, True], [0, 0], 0, 0

        def row() -> pa.RecordBatch:
            records = [end[1] - o - (end[0] - at) * s for o, s in zip(other, state)]
            return pa.RecordBatch.from_pydict({c: [v] for c, v in zip(names, (*key, *state, *records))})

        for batch in batches:
            for found, part in _runs(batch):
                if found != key:
                    if key is not None:
                        yield row()
                    first, n = (part.column(c)[0].as_py() for c in ("first_line", "n_lines"))
                    # lines that begin no record, so far; the first line not looked at; the end and number of lines
                    key, state, other, at, end = found, [False, True], [0, 0], first, (first + n, n)
                for line, text in zip(part.column("line").to_pylist(), part.column("text").to_pylist()):
                    for case in (0, 1):
                        other[case] += (line + 1 - at) if state[case] else text is None
                    at = line + 1
                    if text is not None:
                        met = state[0] == state[1]
                        state[0] = ends_inside(text, state[0])
                        state[1] = state[0] if met else ends_inside(text, state[1])
        if key is not None:
            yield row()

    return asked.mapInArrow(scan, schema)


def split_starts(spark: SparkSession, path: str, pattern: str | None, header: list[str]) -> Starts:
    """Looks at all splits. A file without a line of the header's names, quoted or not, in its first split is an error."""
    lines = _lines(spark, path, pattern)
    names = F.replace(F.ltrim("text", F.lit("\ufeff")), F.lit('"'), F.lit("")) == ",".join(header)
    tally = lines.groupBy(*SPLIT).agg(
        F.min("line").alias("first_line"), F.count("*").alias("n_lines"),
        F.count_if(_quoted()).alias("n_quoted"), F.count_if(_blank()).alias("n_blank"),
        F.count_if(names).alias("n_headers"),
    )
    tally = materialize(tally, "csv-splits")  # one row per split, here and below
    other = tally.where("start = 0 and n_headers = 0").select("file").first()
    if other:
        raise ValueError(f"another header than {','.join(header)}: {other.file}")
    quoted, blank = (x or 0 for x in tally.agg(F.sum("n_quoted"), F.sum("n_blank")).first())
    splits, kept = tally, [*SPLIT, "first_line"]
    if quoted:
        maps = materialize(_maps(lines, tally.select(*kept, "n_lines")), "csv-maps")
        splits = tally.join(F.broadcast(maps), list(SPLIT), "left")
        records = F.coalesce("n_out", "n_lines")
        changes = splits.where(F.coalesce("out_after", F.lit(False)) | (records < F.col("n_lines") - F.col("n_blank")))
        quoted = not changes.isEmpty()
    ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    began = F.col("n_lines") - F.col("n_blank")
    if not quoted:
        base = F.coalesce(F.sum(began).over(ahead), F.lit(0))
        return Starts(splits.select(*kept, F.lit(False).alias("inside"), base.alias("base")), not blank)
    # What a split does to "inside": set it, keep it or swap it.
    sets = F.when(F.col("out_after") == F.col("in_after"), F.struct("out_after", "swaps"))
    swap = F.when(F.col("out_after") & ~F.col("in_after"), 1).otherwise(0)
    known = splits.withColumn("swaps", F.coalesce(F.sum(swap).over(ahead), F.lit(0)))
    known = known.withColumn("last", F.last(sets, ignorenulls=True).over(ahead))
    swapped = (F.col("swaps") - F.coalesce("last.swaps", F.lit(0))) % 2 == 1
    known = known.withColumn("inside", F.coalesce("last.out_after", F.lit(False)) != swapped)
    began = F.when(F.col("inside"), F.coalesce("n_in", F.lit(0))).otherwise(F.coalesce("n_out", began))
    base = F.coalesce(F.sum(began).over(ahead), F.lit(0))
    return Starts(known.select(*kept, "inside", base.alias("base")), False)


def read_pieces(spark: SparkSession, path: str, pattern: str | None, starts: Starts) -> DataFrame:
    """The records of the files as (`file`, `number`, `place`, `text`, `whole`), numbered from 0 in each file.

    Blank lines between records are none. A record that lies in several splits gives one row, not whole, for each; `place` puts
    them in order.
    """
    # one row per split; the join keeps the order of the lines
    lines = _lines(spark, path, pattern).join(F.broadcast(starts.splits), list(SPLIT), "left")
    same_task = F.shiftright("line", POSITION_BITS) == F.shiftright("first_line", POSITION_BITS)
    changed = F.raise_error(F.concat(F.lit("the splits changed while it was read: "), F.col("file")))
    lines = lines.withColumn("base", F.when(same_task, F.col("base")).otherwise(changed.cast("long")))
    if starts.lines_are_records:
        number = F.col("base") + F.col("line") - F.col("first_line")
        return lines.select("file", number.alias("number"), F.col("start").alias("place"), "text", F.lit(True).alias("whole"))
    lines = lines.select(*SPLIT, "inside", "base", "text", _quoted().alias("quotes"), _blank().alias("blank"))
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, number, held, begun = None, False, 0, [], False

        def rows(found: list[tuple]) -> pa.RecordBatch:
            lists = zip(*found) if found else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(lists, types)], names)

        for batch in batches:
            for found, part in _runs(batch):
                if found != key:
                    if held:
                        yield rows([(key[0], number - 1, key[1], "\n".join(held), False)])
                    key, held, begun = found, [], False
                    inside, number = part.column("inside")[0].as_py(), part.column("base")[0].as_py()
                quotes, text = part.column("quotes"), part.column("text")
                at = np.flatnonzero(quotes.to_numpy(zero_copy_only=False)).tolist()
                before, after = _walk(at, text.filter(quotes).to_pylist(), inside, part.num_rows)
                starts_record = ~before & ~part.column("blank").to_numpy(zero_copy_only=False)
                if not before.any() and not after:  # every line that is not blank is a record
                    n = int(starts_record.sum())
                    columns = [
                        pa.array([key[0]] * n, pa.string()), pa.array(number + np.arange(n)), pa.array(np.full(n, key[1])),
                        text.filter(pa.array(starts_record)), pa.array(np.ones(n, bool)),
                    ]
                    number += n
                    yield pa.RecordBatch.from_arrays(columns, names)
                else:
                    out = []
                    ends_open = np.r_[before[1:], after]
                    for line, is_inside, is_start, goes_on in zip(text.to_pylist(), before, starts_record, ends_open):
                        if is_start:
                            number, begun = number + 1, True
                        elif not is_inside:
                            continue
                        held.append(line)
                        if not goes_on:
                            out.append((key[0], number - 1, key[1], "\n".join(held), begun))
                            held, begun = [], False
                    yield rows(out)
                inside = after
        if held:
            yield rows([(key[0], number - 1, key[1], "\n".join(held), False)])

    return lines.mapInArrow(join, RECORD)


def put_together(pieces: DataFrame) -> DataFrame:
    """Whole records from the pieces of each. One beyond `LONGEST_RECORD` is cut to its start, with `text` null-free and
    `whole` false."""
    key = ["file", "number"]
    sizes = pieces.groupBy(*key).agg(F.sum(F.octet_length("text").cast("long")).alias("size"))
    sized = pieces.join(sizes, key)
    short = sized.where(F.col("size") <= LONGEST_RECORD).groupBy(*key).agg(
        F.min("place").alias("place"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda p: p["text"]), "\n").alias("text"),
    )
    long = sized.where(F.col("size") > LONGEST_RECORD).groupBy(*key).agg(
        F.min("place").alias("place"), F.min_by(F.substring("text", 1, SHOWN), "place").alias("text")
    )
    return short.withColumn("whole", F.lit(True)).unionByName(long.withColumn("whole", F.lit(False)))


def read_records(spark: SparkSession, path: str, pattern: str | None, header: list[str]) -> DataFrame:
    """All records of the files, put together where they lie in several splits."""
    starts = split_starts(spark, path, pattern, header)
    pieces = read_pieces(spark, path, pattern, starts)
    if starts.splits.where("inside").isEmpty():
        return pieces
    return pieces.where("whole").unionByName(put_together(pieces.where("not whole")))
