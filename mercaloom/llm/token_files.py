"""Token ids of documents as Parquet list columns, in ascending order of document id.

A file holds a range of ids, sorted. Per document: `part` (the file's place), `doc_id`, `start_in_part` (ids before it
in the file), `n_tokens` and `ids`, closed by the end id. Ids are dictionary-encoded and bit-packed in small row groups
with page indexes, so a reader of some documents skips the pages of the others, and one of the counts reads no ids.

Null texts are empty and give the end id alone; rows with equal ids stand in the order of their texts; a null id comes
first; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

FILE_SCHEMA = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": 16 << 20,
    "parquet.page.size": 1 << 18,
    "parquet.page.row.count.limit": 2000,
}


def with_end(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with the end id after each document, and the documents' new offsets, from 0."""
    offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
    ids = np.full(offsets[-1], tokens.END_ID, np.uint32)
    keep = np.ones(offsets[-1], bool)
    keep[offsets[1:] - 1] = False
    ids[keep] = flat
    return ids, offsets


def crc_of_slices(ids: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Unsigned crc32 of each run of ids as little-endian unsigned 32-bit integers."""
    first = offsets[0]
    data = memoryview(np.ascontiguousarray(ids[first : offsets[-1]]).view("<u4")).cast("B")
    ends = ((offsets - first) * 4).tolist()
    return [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]


def lists_of(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encodes `text` of every row and writes the files; a text is shuffled once, ids never."""
    spark, vocabulary = docs.sparkSession, vocabulary or tokens.vocabulary_path()
    common.bound_batches(spark)
    parts = common.shuffle_parts(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = common.range_bounds(docs, "doc_id", parts)
    placed = docs.withColumn("part", common.range_number(F.col("doc_id"), bounds))
    ordered = placed.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = tokens.encoder(vocabulary), 0
        for batch in common.gathered(batches, "text", tokens.SLICE_BYTES):
            ids, offsets = with_end(*encoder.encode(common.texts_of(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"),
                    batch.column("doc_id"),
                    pa.array(before + offsets[:-1]),
                    pa.array(np.diff(offsets)),
                    lists_of(ids, offsets),
                ],
                ["part", "doc_id", "start_in_part", "n_tokens", "ids"],
            )
            before += int(offsets[-1])

    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**FILE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents with `start`, the number of ids of all documents before; the sizes of the files are read first."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def digest(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids read."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False)
            sums = crc_of_slices(flat, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return files.mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = common.shared_path(spark, "tokens")
    write_token_files(common.read_table(spark, folder, "documents"), path)
    return digest(read_token_files(spark, path))
