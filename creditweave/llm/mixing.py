"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell of source, language and topic. Raking scales
the cells until their sums meet the targets of all three margins; a cell's
ratio of raked to actual tokens calibrates the sampling of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.session import cut_lineage

MARGINS = ("source", "lang", "topic")
# A margin's target share is its token share to this power, brought to sum one.
TEMPERATURE = {"source": 0.7, "lang": 0.8, "topic": 0.8}
SWEEPS = 8
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("long")


def surface_topic(text: Column, words: Column) -> Column:
    """What kind of text it is by its surface: tables, symbols, length."""
    signs = F.regexp_count(text, F.lit("[!-/:-@\\[-`{-~]"))
    return (
        F.when(text.contains(" | "), "table")
        .when(signs * 12 > F.char_length(text), "symbols")
        .when(words < 100, "short")
        .when(words >= 1000, "long")
        .otherwise("prose")
    )


def described(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, source, lang, topic, n_tokens)`` of every row."""
    text = F.coalesce(text_column, F.lit(""))
    counted = docs.select(
        F.col(id_column).alias("id"), F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"), word_count(text).alias("n_tokens"),
    )
    return counted.select("id", "source", "lang", surface_topic(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens")


def targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """``(margin value, target)``: tempered shares of all tokens."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens").alias("tokens"), F.sum(F.pow("tokens", F.lit(power))).alias("tempered"))
    return sums.select(
        margin,
        (F.pow("tokens", F.lit(power)) / total.select("tempered").scalar() * total.select("tokens").scalar()).alias("target"),
    )


def rake(cells: DataFrame, goals: dict[str, DataFrame], sweeps: int) -> DataFrame:
    """``cells`` with ``weight``: scaled to each margin's goals in turn, ``sweeps`` times.

    Margin sums are folded map-side and meet the cells by a join; the cells
    are written after every sweep, so that plans stay short.
    """
    raked = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for margin, goal in goals.items():
            sums = raked.groupBy(margin).agg(F.sum("weight").alias("now"))
            factor = sums.join(goal, margin).select(margin, (F.col("target") / F.col("now")).alias("factor"))
            scaled = F.col("weight") * F.coalesce("factor", F.lit(1.0))
            raked = raked.join(factor, margin, "left").withColumn("weight", scaled).drop("factor")
        raked = cut_lineage(raked)
    return raked


def draw(key: Column, seed: str) -> Column:
    """A number from 0 to below 1 that depends on the key alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def cell_ratios(rows: DataFrame, temperature: dict[str, float], sweeps: int) -> DataFrame:
    """``(source, lang, topic, ratio)`` of the cells of described rows that have tokens."""
    filled = cut_lineage(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    goals = {m: cut_lineage(targets(filled, m, temperature[m])) for m in MARGINS}
    raked = rake(filled, goals, sweeps)
    return raked.select(*MARGINS, (F.col("weight") / F.col("tokens")).alias("ratio"))


def sampled(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` drawn by calibrated probabilities, all columns as they were.

    A row of a cell of ratio r stays with probability r over the largest
    ratio, so that expected token sums are in the targets' proportions over
    all margins and no row is there twice. That costs rows: the cell that is
    raised most is kept whole. Rows of cells without tokens stay. Rows meet
    the table of cells, which is small beside them, and are not shuffled
    unless it is too large to be sent to every executor.
    """
    cells = cut_lineage(described(docs, id_column, text_column))
    ratio = cut_lineage(cell_ratios(cells, TEMPERATURE, SWEEPS).toDF("_source", "_lang", "_topic", "_ratio"))
    largest = ratio.agg(F.max("_ratio")).first()[0] or 1.0
    text = F.coalesce(text_column, F.lit(""))
    topic = surface_topic(text, word_count(text))
    same = (
        (F.coalesce("source", F.lit("unknown")) == F.col("_source"))
        & (F.coalesce("lang", F.lit("und")) == F.col("_lang"))
        & (F.col("_own") == F.col("_topic"))
    )
    met = docs.withColumn("_own", topic).join(ratio, same, "left")
    chance = F.coalesce(F.col("_ratio") / largest, F.lit(1.0))
    return met.where(draw(F.col(id_column), seed) < chance).select(docs.columns)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    temperature: dict[str, float] | None = None,
    sweeps: int = SWEEPS,
    seed: str = SEED,
) -> DataFrame:
    """``(id, source, lang, topic, n_tokens, ratio, probability, weight, kept)`` of every row.

    ``ratio`` is raked over actual tokens of the row's cell. A row is kept
    with probability ``min(1, ratio)`` and then stands for ``weight`` of it,
    so that kept tokens times weight meet the margins' targets in
    expectation. Null source is ``unknown``, null language ``und``, null text
    empty; rows of a cell without tokens are kept with ratio one. Repeated
    rows are drawn alike. Other columns are not read.
    """
    rows = cut_lineage(described(docs, id_column, text_column))
    ratio = cell_ratios(rows, temperature or TEMPERATURE, sweeps)
    joined = rows.join(ratio, list(MARGINS), "left").withColumn("ratio", F.coalesce("ratio", F.lit(1.0)))
    chance = F.least(F.lit(1.0), "ratio")
    return joined.select(
        F.col("id").alias(id_column), *MARGINS, "n_tokens", F.round("ratio", 9).alias("ratio"),
        F.round(chance, 9).alias("probability"), F.round(F.col("ratio") / chance, 9).alias("weight"),
        (draw(F.col("id"), seed) < chance).alias("kept"),
    )
