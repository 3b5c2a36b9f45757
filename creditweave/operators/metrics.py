"""Ranking and calibration metrics over scored, labelled rows.

All of them start from ``score_counts``: one row per distinct score, with
exact running totals from ``running_totals``. No metric sorts the table in one
task or collects it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditweave.functions.numbers import round_to
from creditweave.operators.ordering import running_totals

DIGITS = 6


def score_counts(df: DataFrame, score: str, target: str, by: list[str] | None = None) -> DataFrame:
    """``[by..., score, hits, misses, hits_upto, misses_upto]`` per distinct score.

    Equal scores are counted together map-side first, so a score shared by a
    large part of the rows is one row from here on.
    """
    by = by or []
    counted = (
        df.where(F.col(score).isNotNull() & F.col(target).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(
            F.count_if(F.col(target) == 1).alias("hits"),
            F.count_if(F.col(target) != 1).alias("misses"),
        )
    )
    return running_totals(counted, ["score"], {"hits_upto": "hits", "misses_upto": "misses"}, by)


def _auc_terms() -> list[Column]:
    # Each hit ranks above the misses with lower scores and halfway among the
    # misses with its own score. Doubles: the product of counts outgrows a long.
    below = F.col("misses_upto") - F.col("misses") / 2.0
    return [
        F.sum(F.col("hits") * below).alias("pairs_won"),
        F.sum("hits").alias("p"),
        F.sum("misses").alias("n"),
    ]


def _auc() -> Column:
    possible = F.col("p").cast("double") * F.col("n").cast("double")
    return F.when(possible > 0, round_to(F.col("pairs_won") / possible, DIGITS)).otherwise(F.lit("NaN").cast("double"))


def auc(counts: DataFrame) -> DataFrame:
    """Area under the ROC curve; NaN when only one class is present."""
    return counts.agg(*_auc_terms()).select(_auc().alias("auc"))


def ks(counts: DataFrame) -> DataFrame:
    """Largest gap between the score distributions of the two classes."""
    gap = F.abs(
        F.col("hits_upto") / counts.agg(F.sum("hits")).scalar()
        - F.col("misses_upto") / counts.agg(F.sum("misses")).scalar()
    )
    return counts.agg(round_to(F.max(gap), DIGITS).alias("ks"))


def brier(df: DataFrame, target: str, scores: dict[str, str]) -> DataFrame:
    """Mean squared error for each named score column."""
    return df.agg(
        *[round_to(F.avg((F.col(c) - F.col(target)) * (F.col(c) - F.col(target))), DIGITS).alias(name) for name, c in scores.items()]
    )


def calibration_verdict(scored: DataFrame, target: str, raw: str, calibrated: str) -> DataFrame:
    """Brier score before and after calibration, and whether it got better."""
    both = brier(scored, target, {"brier_raw": raw, "brier_calibrated": calibrated})
    better = F.col("brier_calibrated") < F.col("brier_raw")
    return both.withColumn("verdict", F.when(better, "better").otherwise("worse"))


def quantile_edges(counts: DataFrame, bins: int) -> list[float]:
    """Interior quantile edges with linear interpolation between neighbours.

    Found by rank in the running totals; only ``2 * (bins - 1)`` numbers leave
    the executors.
    """
    upto = F.col("hits_upto") + F.col("misses_upto")
    total = counts.agg(F.sum(F.col("hits") + F.col("misses"))).first()[0] or 0
    if total == 0:
        return []
    # Edge k lies (total - 1) * k / bins ranks into the sorted scores: between
    # the rank below and the next one.
    ranks = [divmod((total - 1) * k, bins) for k in range(1, bins)]
    picks = []
    for below, _ in ranks:
        for rank in (below, min(below + 1, total - 1)):
            picks.append(F.min(F.when(upto > rank, F.col("score"))))
    found = counts.agg(F.array(*picks)).first()[0]
    pairs = zip(found[0::2], found[1::2], ranks)
    return [low + (high - low) * (rest / bins) for low, high, (_, rest) in pairs]


def reliability(counts: DataFrame, bins: int = 10) -> DataFrame:
    """Mean predicted against observed rate per quantile bin; empty bins drop."""
    edges = quantile_edges(counts, bins)
    place = sum((F.when(F.col("score") > e, 1).otherwise(0) for e in edges), F.lit(0))
    rows = F.col("hits") + F.col("misses")
    binned = counts.groupBy(place.alias("bin")).agg(
        F.sum(rows).alias("n"),
        F.sum(F.col("score") * rows).alias("score_sum"),
        F.sum("hits").alias("hits"),
    )
    return binned.select(
        "bin",
        "n",
        round_to(F.col("score_sum") / F.col("n"), DIGITS).alias("mean_predicted"),
        round_to(F.col("hits") / F.col("n"), DIGITS).alias("observed_rate"),
    )


def slice_metrics(df: DataFrame, score: str, target: str, slice_by: str) -> DataFrame:
    """Per slice: rows, observed rate, mean prediction and AUC."""
    counts = score_counts(df, score, target, [slice_by])
    rows = F.col("hits") + F.col("misses")
    summed = counts.groupBy(slice_by).agg(
        F.sum(rows).alias("rows"), F.sum(F.col("score") * rows).alias("score_sum"), *_auc_terms()
    )
    return summed.select(
        slice_by,
        F.col("rows").alias("n"),
        round_to(F.col("p") / F.col("rows"), DIGITS).alias("observed_rate"),
        round_to(F.col("score_sum") / F.col("rows"), DIGITS).alias("mean_predicted"),
        _auc().alias("auc"),
    )
