"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling of documents.

The tokens (words) of the table are summed per cell of source, language and topic. The cells' weights are raked until
their sums meet the target shares of each source, language and topic. A cell's rate is its fitted weight over its
tokens, scaled so that `keep` of all tokens are expected and no rate is over 1; a document stays if the hash of its id
is below the rate of its cell, so a rerun keeps the same ones. DataFrame functions only.

By default a share is the share of tokens to the power 0.7, which lifts the small ones, and the topic is the text's
lexical register: its mean word length in half letters, 9 to 16, which stands in for a topic. Every source and every
language has cells of its own. The cells that occur are raked in one task; if they are few enough to be broadcast, no
text is shuffled.

Null and empty texts have no tokens and are kept; a null source or language is a value of its own. Rows with equal ids
stay or go together where their cells are the same. An empty table gives no rows. Cells that no target can reach
(their source, language and topic contradict each other) end with the weights of the last round. Input columns with
the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

POWER, KEEP, ROUNDS, SEED = 0.7, 0.7, 10, 11
NONE = "*none*"
CELL = ["_source", "_lang", "_topic"]
SPACE = "[ \\t-\\r]+"


def word_count(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def lexical_register(length: Column, words: Column) -> Column:
    """Half letters per word, from 9 to 16."""
    return F.least(F.lit(16), F.greatest(F.lit(9), F.floor(2 * length / F.greatest(words, F.lit(1))))).cast("string")


def with_cells(docs: DataFrame, topic: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents, their columns renamed by place, with their id, tokens and cell; and the tokens of each cell."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"_column_{i}") for i, c in enumerate(docs.columns)),
        "doc_id",
        "source",
        "lang",
        F.length(text).alias("_length"),
        word_count(text).alias("_n_tokens"),
        (F.lit(None) if topic is None else topic).cast("string").alias("_topic"),
    )
    if topic is None:
        rows = rows.withColumn("_topic", lexical_register(F.col("_length"), F.col("_n_tokens")))
    counted = rows.withColumn("_topic", F.coalesce("_topic", F.lit(NONE)))
    counted = counted.withColumns({f"_{c}": F.coalesce(c, F.lit(NONE)) for c in ("source", "lang")})
    cells = counted.groupBy(*CELL).agg(F.sum("_n_tokens").alias("tokens")).where("tokens > 0")
    return counted, common.store(cells, "mix-cells").coalesce(1)


def fitted(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The cells with `weight`, raked in turn to the shares of source, language and topic; the weights sum to 1."""
    targets = targets or {}
    whole = Window.partitionBy()
    out = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(whole))
    for name in CELL:
        given = targets.get(name.lstrip("_"))
        own = F.sum("tokens").over(Window.partitionBy(name)) / F.sum("tokens").over(whole)
        raw = F.pow(own, F.lit(POWER))
        if given:
            raw = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in given.items() for x in kv)), F.col(name)), F.lit(0.0))
        out = out.withColumn(f"_raw{name}", raw)
        once = F.row_number().over(Window.partitionBy(name).orderBy(*CELL)) == 1
        out = out.withColumn(f"_once{name}", F.when(once, F.col(f"_raw{name}")).otherwise(0.0))
        out = out.withColumn(f"_target{name}", F.col(f"_raw{name}") / F.sum(f"_once{name}").over(whole))
    out = out.select(*CELL, "tokens", "weight", *(f"_target{c}" for c in CELL))
    for _ in range(rounds):
        for name in CELL:
            has = F.sum("weight").over(Window.partitionBy(name))
            out = out.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"_target{name}") / has).otherwise(0.0))
    return out.withColumn("weight", F.col("weight") / F.sum("weight").over(whole))


def rates(weighted: DataFrame, keep: float = KEEP) -> DataFrame:
    """The cells with `rate`: weight over tokens, scaled to keep a share of all tokens, cells that reach 1 set aside."""
    down = Window.orderBy(F.desc("_ratio"), *CELL)
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = weighted.withColumn("_ratio", F.col("weight") / F.col("tokens"))
    ranked = ranked.withColumns(
        {
            "_full": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
            "_open": 1 - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "_all": F.sum("tokens").over(whole),
        }
    )
    # the scale if all cells before this one are full; the first cell that then stays below 1 gives the scale
    ranked = ranked.withColumn("_scale", (keep * F.col("_all") - F.col("_full")) / F.col("_open"))
    fits = F.when((F.col("_scale") * F.col("_ratio") <= 1) & (F.col("_open") > 1e-12), F.struct("_full", "_scale"))
    scale = F.coalesce(F.min(fits).over(whole)["_scale"], F.lit(float("inf")))
    return ranked.withColumn("_c", scale).withColumn(
        "rate", F.when(F.col("_ratio") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_c") * F.col("_ratio")))).otherwise(0.0)
    ).select(*CELL, "tokens", "weight", "rate")


def chance(key: Column, seed: int = SEED) -> Column:
    """A number from 0 to 1 that depends on the id and the seed only."""
    digits = F.substring(F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed)))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    keep: float = KEEP,
    topic: Column | None = None,
    prefix: str = "",
) -> DataFrame:
    """All rows with `n_tokens`, `topic`, the `rate` of their cell and whether they are `kept`, named with `prefix`."""
    names = {c: prefix + c for c in ("n_tokens", "topic", "rate", "kept")}
    own = [F.col(f"_column_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in names.values()]
    counted, cells = with_cells(docs, topic)
    total, n_cells = cells.agg(F.sum("tokens"), F.count("*")).first()
    rated = rates(fitted(cells, targets), keep).select(F.struct(*CELL).alias("_cell"), F.col("tokens").alias("_weight"), F.col("rate").alias("_rate"))
    counted = counted.withColumn("_cell", F.struct(*CELL))
    if n_cells <= common.BROADCAST_ROWS:
        joined = counted.join(F.broadcast(rated), "_cell", "left")
    else:
        joined = common.join_counted(counted, common.store(rated, "mix-rates"), "_cell", "_weight", total)
    rate = F.coalesce("_rate", F.lit(1.0))
    return joined.select(
        *own,
        F.col("_n_tokens").alias(names["n_tokens"]),
        F.col("_topic").alias(names["topic"]),
        rate.alias(names["rate"]),
        (chance(F.col("doc_id")) < rate).alias(names["kept"]),
    )


def op9_rake_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.read_table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return mix(docs).drop("text")
