"""Declared schemas, typed contracts and column descriptions."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    """Build a schema from ``"name type, name type"``."""
    fields = [part.split() for part in spec.replace("\n", " ").split(",")]
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])


# Bronze tables. The column names and types other systems deliver.
APPLICATION_TRAIN = """
    sk_id_curr bigint, target int, name_contract_type string, code_gender string,
    flag_own_car string, flag_own_realty string, cnt_children int,
    amt_income_total double, amt_credit double, amt_annuity double,
    amt_goods_price double, name_income_type string, name_education_type string,
    name_family_status string, days_birth int, days_employed int
"""
BUREAU = """
    sk_id_curr bigint, sk_id_bureau string, credit_active string,
    credit_type string, days_credit int, credit_day_overdue int,
    amt_credit_sum double, amt_credit_sum_debt double,
    amt_credit_sum_overdue double
"""
INSTALLMENTS_PAYMENTS = """
    sk_id_prev bigint, sk_id_curr bigint, num_instalment_version bigint,
    num_instalment_number int, days_instalment int, days_entry_payment int,
    amt_instalment double, amt_payment double
"""
PD_PREDICTIONS = """
    application_id bigint, predicted_pd double,
    top1_feature string, top1_shap double, top2_feature string,
    top2_shap double, top3_feature string, top3_shap double
"""
FEATURE_LABELS = "feature_name string, feature_label string"

BRONZE = {
    "application_train": APPLICATION_TRAIN,
    "bureau": BUREAU,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "pd_predictions": PD_PREDICTIONS,
    "feature_labels": FEATURE_LABELS,
}

# Gold contracts. Names and types the marts must keep.
APPLICATIONS_CONTRACT = """
    application_id bigint, is_default int, contract_type string,
    income_total double, credit_amount double, annuity_amount double,
    age_years int, employment_years double, prior_credit_count bigint,
    active_credit_count bigint, total_credit_debt double,
    total_credit_overdue double, max_days_overdue int,
    credit_to_income_ratio double, annuity_to_income_ratio double
"""
PAYMENTS_CONTRACT = """
    payment_id string, prior_credit_id bigint, application_id bigint,
    installment_version int, installment_number int, installment_due_day int,
    payment_entry_day int, installment_amount double, payment_amount double,
    payment_shortfall double, days_late int
"""

# The reader's schema of the other two marts; their columns come from upstream.
SCORED = APPLICATIONS_CONTRACT.rstrip() + "," + PD_PREDICTIONS.replace("application_id bigint,", "")
DECLINES = """
    application_id bigint, predicted_pd double, decline_rank bigint,
    top1_feature string, top1_label string, top2_feature string,
    top2_label string, top3_feature string, top3_label string,
    driver_list string, adverse_action_reason string
"""

CONTRACTS = {
    "applications": APPLICATIONS_CONTRACT,
    "payments": PAYMENTS_CONTRACT,
    "scored": SCORED,
    "declines": DECLINES,
}


def contract(table: str) -> T.StructType:
    """The schema of a gold table, with its column descriptions as comments."""
    texts = DESCRIPTIONS.get(table, {})
    fields = struct(CONTRACTS[table]).fields
    return T.StructType(
        [T.StructField(f.name, f.dataType, True, {"comment": texts[f.name]} if f.name in texts else {}) for f in fields]
    )


# Our own wording: what each table holds, and what each column says. The latter
# is written into the files as column comments.
TABLE_DESCRIPTIONS = {
    "applications": "One row per loan application: features for the default model.",
    "payments": "One row per payment event of an earlier credit.",
    "scored": "Applications with their predicted default probability and main drivers.",
    "declines": "Declined applications with their labelled drivers and reason text.",
}
DESCRIPTIONS = {
    "applications": {
        "application_id": "Key of the application.",
        "is_default": "1 when the client ran into payment difficulties.",
        "contract_type": "Kind of loan.",
        "income_total": "Declared income.",
        "credit_amount": "Amount of the loan.",
        "annuity_amount": "Amount of one regular repayment.",
        "age_years": "Whole years of age on application.",
        "employment_years": "Years in current job; empty when not employed.",
        "prior_credit_count": "Earlier credits on file; 0 without history.",
        "active_credit_count": "Earlier credits that are still open.",
        "total_credit_debt": "Outstanding debt over all earlier credits; 0 both without history and when no debt is reported.",
        "total_credit_overdue": "Overdue amount over all earlier credits.",
        "max_days_overdue": "Longest overdue period in days.",
        "credit_to_income_ratio": "Loan over income; empty when income is 0 or unknown.",
        "annuity_to_income_ratio": "Repayment over income; empty when income is 0 or unknown.",
    },
    "payments": {
        "payment_id": "Hash key of the payment event.",
        "prior_credit_id": "Earlier credit that was paid.",
        "application_id": "Application the earlier credit belongs to.",
        "installment_version": "Version of the repayment calendar.",
        "installment_number": "Position in the repayment calendar.",
        "installment_due_day": "Due day, counted from the application.",
        "payment_entry_day": "Day the money arrived; empty when unpaid.",
        "installment_amount": "Amount due.",
        "payment_amount": "Amount paid; empty when unpaid.",
        "payment_shortfall": "Due minus paid.",
        "days_late": "Entry day minus due day.",
    },
    "scored": {
        "predicted_pd": "Modelled probability of default, between 0 and 1.",
        "top1_feature": "Feature with the largest contribution to the score.",
        "top1_shap": "Contribution of that feature; positive raises the risk.",
        "top2_feature": "Feature with the second largest contribution.",
        "top2_shap": "Contribution of the second feature.",
        "top3_feature": "Feature with the third largest contribution.",
        "top3_shap": "Contribution of the third feature.",
    },
    "declines": {
        "application_id": "Key of the declined application.",
        "predicted_pd": "Modelled probability of default that led to declining.",
        "decline_rank": "Place by falling risk.",
        "top1_feature": "Feature with the largest contribution to the score.",
        "top1_label": "Its phrase for applicants.",
        "top2_feature": "Feature with the second largest contribution.",
        "top2_label": "Its phrase for applicants.",
        "top3_feature": "Feature with the third largest contribution.",
        "top3_label": "Its phrase for applicants.",
        "driver_list": "The labelled drivers in order; a reason cites nothing else.",
        "adverse_action_reason": "Reason text for the applicant.",
    },
}
DESCRIPTIONS["scored"] = DESCRIPTIONS["applications"] | DESCRIPTIONS["scored"]
