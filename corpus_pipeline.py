"""The corpus pipeline: stages over the documents table, each written as Parquet and read again by the next.

1. language ID: documents that the classifier, trained on their own `lang`, rejects go: those without a letter
   (`und`) and those whose best language has a mean probability below `LEAST_SCORE`, or below what all but a thousandth
   of the labelled windows have, if that is less (many languages share the probability).
2. line dedup: of repeated passages of two or more lines the first stays; `n_chars` is counted anew. No document goes.
3. n-gram Jaccard join: texts whose sets of five-word shingles have a Jaccard likeness of 0.8 or more are linked; of
   each component of near-duplicates the row with the smallest id stays; documents
   without words stay, and so do rows that share the smallest id.
4. mixing: documents are sampled by the rates of their source, language and topic.
5. packing: the pieces of the packed sequences.

All stages but the last return the columns of their input; other columns than those of documents travel under names that
no stage uses and come out as they went in. Their empty tables, nulls, ties and repeated rows are
handled as the operators say.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercaloom.llm import byte_cnn, common, jaccard_rtree, line_chunks, mixture_packing, rake_mixing

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.4
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in like.columns))


def _as_documents(stage: Stage) -> Stage:
    """The stage, with the columns that documents do not have renamed before it and named back after it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inner = [c if c in DOCUMENTS else f"_input_{i}" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*inner), sf_dir).toDF(*names)

    return run_stage


@_as_documents
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = byte_cnn.train(docs.where(byte_cnn.bucket(F.col("doc_id"), 4) != 2))
    judged = byte_cnn.identify(docs, model, "_lang_pred", "_lang_score")
    least = min(LEAST_SCORE, model.floor) if model else LEAST_SCORE
    accepted = (F.col("_lang_pred") != byte_cnn.UNKNOWN) & (F.col("_lang_score") >= least)
    return _columns(judged.where(accepted), docs)


@_as_documents
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_chunks.dedup_lines(docs, "_n_lines", "_n_removed")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _columns(kept, docs)


@_as_documents
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    joined = jaccard_rtree.linked_components(docs, NEAR_PERCENT, NEAR_WIDTH)
    # the smallest id names the component, so it is the one that stays
    stays = joined.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stays")).distinct()
    kept = docs.join(stays, F.col("doc_id").eqNullSafe(F.col("_stays")), "left_semi")
    return _columns(kept, docs)


@_as_documents
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(rake_mixing.mix(docs, prefix="_mix_").where("_mix_kept"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# A trained classifier and a byte-pair vocabulary are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
