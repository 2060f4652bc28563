"""The queries of the operators and of the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .boosted_quality import op11_boosted_quality
from .byte_cnn import op7_byte_cnn
from .impact_topk import OP10_SQL, op10_impact_topk
from .jaccard_rtree import op6_jaccard_rtree
from .line_chunks import OP4_SQL, op4_line_chunks
from .lz_fingerprint import op5_lz_fingerprint
from .mixture_packing import op8_mixture_packing
from .ngram_trie import op1_ngram_trie
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .rake_mixing import op9_rake_mixing
from .suffix_dedup import op2_suffix_dedup
from .token_alignment import op13_token_alignment
from .token_files import op3_token_files

Query = Callable[[SparkSession, str], DataFrame]

OPERATORS: tuple[Query, ...] = (
    op1_ngram_trie,
    op2_suffix_dedup,
    op3_token_files,
    op4_line_chunks,
    op5_lz_fingerprint,
    op6_jaccard_rtree,
    op7_byte_cnn,
    op8_mixture_packing,
    op9_rake_mixing,
    op10_impact_topk,
    op11_boosted_quality,
    op12_prefix_trie,
    op13_token_alignment,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


def expected_sql() -> dict[str, str]:
    return {"op4_line_chunks": OP4_SQL, "op10_impact_topk": OP10_SQL, "op12_prefix_trie": OP12_SQL}
