"""The gated build: every table is checked before anything reads it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession

from creditweave.operators import checks, grounding, marts, reasons, staging
from creditweave.plans.catalogue import CATALOGUE
from creditweave.session import cut_lineage, scratch_path
from creditweave.settings import ID, TARGET, Policy
from creditweave.sources.schemas import PD_PREDICTIONS, struct
from creditweave.sources.tables import label_dictionary, scan, write_and_count
from creditweave.sources.versioned import VersionedTable


def bronze_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The raw tables below ``root``, one Parquet folder each."""
    names = ("application_train", "bureau", "installments_payments")
    return {name: scan(spark, f"{root}/{name}", name) for name in names}


def present(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": checks.is_missing(c) for c in columns}


def gates(table: str) -> dict[str, Column]:
    """The declared row rules of a table, by a name to report."""
    return {f"{column} {check}": rule for (check, column), rule in CATALOGUE[table].rules().items()}


def gold_tables(spark: SparkSession, root: str) -> dict[str, VersionedTable]:
    """The gold tables below ``root``, clustered for how they are read."""
    return {
        "applications": VersionedTable(spark, f"{root}/applications", "applications", ID),
        # Payments are looked up per applicant, scores by risk.
        "payments": VersionedTable(
            spark, f"{root}/payments", "payments", "payment_id", "installment_due_day", (ID,)
        ),
        "scored": VersionedTable(spark, f"{root}/scored", "scored", ID, cluster_by=("predicted_pd",)),
        "declines": VersionedTable(spark, f"{root}/declines", "declines", ID),
    }


def check_staged(applications: DataFrame, credits: DataFrame, payments: DataFrame) -> None:
    """One pass per table for the row rules, one shuffle per key for uniqueness."""
    checks.require_rows(
        "applications",
        applications,
        {
            **present(ID, TARGET, "income_total"),
            "is_default accepted": checks.not_accepted(TARGET, [0, 1]),
            "employment_years range": checks.outside("employment_years", 0, 100),
        },
    )
    checks.require_empty("applications unique", checks.unique(applications, ID))
    amounts = {f"{c} can be summed": checks.not_summable(c) for c in ("credit_debt", "credit_overdue")}
    checks.require_rows("credits", credits, {**present("bureau_credit_id", ID, "credit_status"), **amounts})
    checks.require_empty("credits unique", checks.unique(credits, "bureau_credit_id"))
    checks.require_rows("payments", payments, present("payment_id", ID, "installment_due_day"))


def build_features(spark: SparkSession, bronze: dict[str, DataFrame], root: str) -> dict[str, VersionedTable]:
    """Bronze tables to the feature mart and the payment fact."""
    applications = staging.stage_applications(bronze["application_train"])
    credits = staging.stage_credits(bronze["bureau"])
    payments = staging.stage_payments(bronze["installments_payments"])
    check_staged(applications, credits, payments)

    tables = gold_tables(spark, root)
    # Checked, then joined: computed once.
    rollup = cut_lineage(marts.credit_rollup(credits))
    too_many = checks.outside("prior_credit_count", 1, 1000)
    checks.require_rows("rollup", rollup, {**present(ID), "prior_credit_count range": too_many})
    # The mart is checked while it is written.
    tables["applications"].refresh(marts.applicant_features(applications, rollup), gates("applications"))
    tables["payments"].upsert(payments)
    return tables


def build_decisions(
    spark: SparkSession,
    predictions: DataFrame,
    root: str,
    policy: Policy = Policy(),
    labels: DataFrame | None = None,
    write_reason: Callable[[pd.Series], pd.Series] | None = None,
) -> dict[str, VersionedTable]:
    """Predictions and the feature mart to scored applications and declines."""
    gate = checks.require_empty
    tables = gold_tables(spark, root)
    labels = label_dictionary(spark) if labels is None else labels
    checks.require_rows("labels", labels, present("feature_name", "feature_label"))
    for column in ("feature_name", "feature_label"):
        gate(f"labels unique {column}", checks.unique(labels, column))

    mart = tables["applications"].read()
    # The prediction table: written once, verified by its count, and read by all that follows.
    path, schema = scratch_path(spark, "predictions"), struct(PD_PREDICTIONS)
    written = write_and_count(predictions.select(*schema.names), path)
    staged = staging.stage_predictions(spark.read.schema(schema).parquet(path))
    if written != staged.count():
        raise checks.CheckFailed("predictions written", written)
    checks.require_rows(
        "predictions",
        staged,
        {
            **present(ID, "predicted_pd", "top1_feature"),
            "predicted_pd range": checks.outside("predicted_pd", 0, 1),
        },
    )
    gate("predictions unique", checks.unique(staged, ID))
    gate("predictions without application", checks.orphans(staged, ID, mart, ID))
    tables["scored"].refresh(marts.scored_applicants(mart, staged), gates("scored"))

    drivers = cut_lineage(marts.declined_drivers(tables["scored"].read(), labels, policy))
    named = [f"top{i}_label" for i in (1, 2, 3)]
    checks.require_rows("drivers", drivers, present(ID, "predicted_pd", *named, "driver_list"))
    # Pinned, so that the gates read the very texts that get published.
    explained = cut_lineage(reasons.with_reason(drivers, write_reason))
    checks.require_rows("reasons", explained, present("adverse_action_reason"))
    gate("reasons cite foreign factors", grounding.ungrounded_citations(explained, labels))
    tables["declines"].refresh(explained, gates("declines"))
    return tables
