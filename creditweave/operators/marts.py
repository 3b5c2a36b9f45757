"""Applicant rollup, feature mart, scored mart and declined drivers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditweave.functions.numbers import exact_sum, safe_divide
from creditweave.functions.text import driver_list
from creditweave.operators.ordering import numbered, top_numbered
from creditweave.settings import ID, Policy

# Rollup columns; zero for applicants without history.
HISTORY = [
    "prior_credit_count",
    "active_credit_count",
    "total_credit_debt",
    "total_credit_overdue",
    "max_days_overdue",
]


def credit_rollup(credits: DataFrame) -> DataFrame:
    """Many credits to one row per applicant.

    All aggregates combine map-side, so an applicant holding a large share of
    the credits still reaches the reducer as one row per map task.
    """
    return credits.groupBy(ID).agg(
        F.count(F.lit(1)).alias("prior_credit_count"),
        F.count_if(F.col("credit_status") == "Active").alias("active_credit_count"),
        exact_sum(F.col("credit_debt")).alias("total_credit_debt"),
        exact_sum(F.col("credit_overdue")).alias("total_credit_overdue"),
        F.max("days_overdue").alias("max_days_overdue"),
    )


def applicant_features(applications: DataFrame, rollup: DataFrame) -> DataFrame:
    """The feature mart: applicants without history stay, with zeros."""
    income = F.col("income_total")
    return applications.join(rollup, ID, "left").select(
        ID,
        "is_default",
        "contract_type",
        "income_total",
        "credit_amount",
        "annuity_amount",
        "age_years",
        "employment_years",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in HISTORY],
        safe_divide(F.col("credit_amount"), income).alias("credit_to_income_ratio"),
        safe_divide(F.col("annuity_amount"), income).alias("annuity_to_income_ratio"),
    )


def scored_applicants(applications: DataFrame, predictions: DataFrame) -> DataFrame:
    """Mart rows with their prediction; rows without one drop out."""
    return applications.join(predictions, ID, "inner")


def declined_drivers(scored: DataFrame, labels: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Declined applicants, ranked by risk, with labelled drivers.

    Declined rows are numbered by ranges of risk, never in one task; of a
    sample size, the riskiest are selected by counting before any row is
    shuffled.
    """
    drivers = [f"top{i}_{part}" for i in (1, 2, 3) for part in ("feature", "shap")]
    declined = scored.where(F.col("predicted_pd") >= policy.decline_threshold).select(
        ID, "predicted_pd", *drivers
    )
    if policy.decline_sample_size is None:
        falling = declined.withColumn("_safety", -F.col("predicted_pd"))
        ranked = numbered(falling, ["_safety", ID], "decline_rank").drop("_safety")
    else:
        ranked = top_numbered(declined, ["predicted_pd", ID], "decline_rank", policy.decline_sample_size)
    for i in (1, 2, 3):
        names = labels.select(
            F.col("feature_name").alias(f"top{i}_feature"), F.col("feature_label").alias(f"top{i}_label")
        )
        ranked = ranked.join(names, f"top{i}_feature", "left")
    labelled = [F.col(f"top{i}_label") for i in (1, 2, 3)]
    columns = [f"top{i}_{part}" for i in (1, 2, 3) for part in ("feature", "label", "shap")]
    return ranked.select(
        ID, "predicted_pd", "decline_rank", *columns, driver_list(labelled).alias("driver_list")
    )
