"""One-pass summaries of the marts and the predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditweave.sources.tables import write_table


def portfolio_scalars(scored: DataFrame, declines: DataFrame) -> DataFrame:
    """The six figures asked of the scored portfolio, in one row.

    The high-risk count is strict (above 0.3) while declining is not (0.30 and
    above).
    """
    pd_ = F.col("predicted_pd")
    portfolio = scored.agg(
        F.round(F.avg(pd_), 4).alias("avg_pd"),
        F.count(F.lit(1)).alias("scored_applications"),
        F.count_if(pd_ > 0.3).alias("pd_above_030"),
        F.round(F.max(pd_), 4).alias("max_pd"),
        F.count_if(F.col("is_default") == 1).alias("actual_defaulters"),
    )
    reasons = declines.agg(F.count(F.lit(1)).alias("reasons_generated"))
    return portfolio.withColumn("reasons_generated", reasons.scalar())


def driver_frequency(predictions: DataFrame, top: int = 3) -> DataFrame:
    """The most frequent main drivers, by name when equally frequent."""
    counted = predictions.groupBy("top1_feature").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "top1_feature").limit(top)


def scoring_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("scored"), F.round(F.avg("predicted_pd"), 4).alias("mean_pd")
    )


def feature_export_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("is_default"), 4).alias("default_rate"),
    ).withColumn("n_columns", F.lit(len(mart.columns)))


def export_features(mart: DataFrame, path: str) -> DataFrame:
    """Write a snapshot of the mart and report on what was written."""
    return feature_export_summary(write_table(mart, path, "applications"))
