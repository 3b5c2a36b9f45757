"""Bronze tables to conformed, typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditweave.functions import numbers
from creditweave.sources import schemas


def stage_applications(raw: DataFrame) -> DataFrame:
    employed = F.col("days_employed")
    return raw.select(
        F.col("sk_id_curr").cast("bigint").alias("application_id"),
        F.col("target").alias("is_default"),
        F.col("name_contract_type").alias("contract_type"),
        F.col("code_gender").alias("gender"),
        F.col("flag_own_car").alias("owns_car"),
        F.col("flag_own_realty").alias("owns_realty"),
        F.col("cnt_children").cast("int").alias("children_count"),
        F.col("amt_income_total").cast("double").alias("income_total"),
        F.col("amt_credit").cast("double").alias("credit_amount"),
        F.col("amt_annuity").cast("double").alias("annuity_amount"),
        F.col("amt_goods_price").cast("double").alias("goods_price"),
        F.col("name_income_type").alias("income_type"),
        F.col("name_education_type").alias("education_type"),
        F.col("name_family_status").alias("family_status"),
        numbers.years_whole(F.col("days_birth")).alias("age_years"),
        numbers.scrub_not_employed(employed, numbers.years_fraction(employed)).alias("employment_years"),
    )


def stage_credits(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("sk_id_curr").cast("bigint").alias("application_id"),
        F.col("sk_id_bureau").alias("bureau_credit_id"),
        F.col("credit_active").alias("credit_status"),
        "credit_type",
        (-F.col("days_credit")).cast("int").alias("days_since_credit_opened"),
        F.col("credit_day_overdue").cast("int").alias("days_overdue"),
        F.col("amt_credit_sum").cast("double").alias("credit_sum"),
        F.col("amt_credit_sum_debt").cast("double").alias("credit_debt"),
        F.col("amt_credit_sum_overdue").cast("double").alias("credit_overdue"),
    )


def stage_payments(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Conformed payments, with the columns named in ``carry`` as they are."""
    due, entry = F.col("days_instalment").cast("int"), F.col("days_entry_payment").cast("int")
    owed, paid = F.col("amt_instalment").cast("double"), F.col("amt_payment").cast("double")
    return raw.select(
        # Hashes the raw values: a change of their type changes the key.
        numbers.surrogate_key(
            "sk_id_prev",
            "num_instalment_version",
            "num_instalment_number",
            "days_entry_payment",
            "amt_payment",
        ).alias("payment_id"),
        F.col("sk_id_prev").cast("bigint").alias("prior_credit_id"),
        F.col("sk_id_curr").cast("bigint").alias("application_id"),
        F.col("num_instalment_version").cast("int").alias("installment_version"),
        F.col("num_instalment_number").cast("int").alias("installment_number"),
        due.alias("installment_due_day"),
        entry.alias("payment_entry_day"),
        owed.alias("installment_amount"),
        paid.alias("payment_amount"),
        (owed - paid).alias("payment_shortfall"),
        (entry - due).alias("days_late"),
        *carry,
    )


def stage_predictions(raw: DataFrame) -> DataFrame:
    schema = schemas.struct(schemas.PD_PREDICTIONS)
    return raw.select([F.col(f.name).cast(f.dataType) for f in schema])
