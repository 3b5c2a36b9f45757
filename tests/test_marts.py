"""Rollup, feature mart, scored mart and declined drivers."""

from conftest import SMALL, rows
from pyspark.sql import functions as F

from creditweave.operators import marts, scorecard
from creditweave.plans import registry
from creditweave.settings import FEATURES, Policy
from creditweave.sources.tables import label_dictionary

CREDITS = "application_id bigint, credit_status string, credit_debt double, credit_overdue double, days_overdue int"
APPLICATIONS = """application_id bigint, is_default int, contract_type string, income_total double,
    credit_amount double, annuity_amount double, age_years int, employment_years double"""
ROLLUP = """application_id bigint, prior_credit_count bigint, active_credit_count bigint,
    total_credit_debt double, total_credit_overdue double, max_days_overdue int"""
SCORED = """application_id bigint, predicted_pd double, top1_feature string, top1_shap double,
    top2_feature string, top2_shap double, top3_feature string, top3_shap double"""
LABELS = [
    ("employment_years", "job length"),
    ("credit_to_income_ratio", "loan to income"),
    ("total_credit_debt", "other debt"),
    ("credit_amount", "loan size"),
    ("age_years", "age"),
    ("income_total", "income"),
]


def test_rollup_is_one_row_per_applicant(spark):
    credits = spark.createDataFrame(
        [(100, "Active", 1000.0, 50.0, 10), (100, "Closed", 500.0, 0.0, 0), (200, "Active", 300.0, 0.0, 5)], CREDITS
    )
    got = [tuple(r) for r in marts.credit_rollup(credits).orderBy("application_id").collect()]
    assert got == [(100, 2, 1, 1500.0, 50.0, 10), (200, 1, 1, 300.0, 0.0, 5)]


def test_rollup_of_null_debts_is_null_then_zero(spark):
    credits = spark.createDataFrame([(1, "Active", None, None, None)], CREDITS)
    rollup = marts.credit_rollup(credits)
    assert tuple(rollup.first()) == (1, 1, 1, None, None, None)
    applications = spark.createDataFrame([(1, 0, "x", 1.0, 1.0, 1.0, 30, 1.0)], APPLICATIONS)
    row = marts.applicant_features(applications, rollup).first()
    assert (row["prior_credit_count"], row["total_credit_debt"]) == (1, 0.0)


def test_features_without_history_and_without_income(spark):
    applications = spark.createDataFrame(
        [(1, 0, "Cash loans", 10000.0, 30000.0, 1000.0, 40, 5.0), (2, 1, "Cash loans", 0.0, 5000.0, 200.0, 30, None)],
        APPLICATIONS,
    )
    rollup = spark.createDataFrame([(1, 3, 1, 500.0, 0.0, 12)], ROLLUP)
    first, second = rows(marts.applicant_features(applications, rollup), "application_id")
    assert (first["credit_to_income_ratio"], first["annuity_to_income_ratio"]) == (3.0, 0.1)
    assert (first["prior_credit_count"], first["max_days_overdue"]) == (3, 12)
    zeros = [second[c] for c in FEATURES[6:11]]
    assert zeros == [0, 0, 0.0, 0.0, 0]
    assert second["credit_to_income_ratio"] is None and second["annuity_to_income_ratio"] is None


def scored_rows(spark):
    return spark.createDataFrame(
        [
            (1, 0.50, "employment_years", 0.20, "credit_to_income_ratio", 0.10, "total_credit_debt", 0.05),
            (2, 0.40, "credit_amount", 0.18, "age_years", 0.09, "income_total", 0.04),
            (3, 0.10, "age_years", 0.01, "income_total", 0.01, "credit_amount", 0.01),
        ],
        SCORED,
    )


def test_declined_drivers_threshold_rank_cap_and_text(spark):
    labels = spark.createDataFrame(LABELS, "feature_name string, feature_label string")
    got = rows(marts.declined_drivers(scored_rows(spark), labels, Policy(0.30, 2)), "decline_rank")
    assert [(r["application_id"], r["decline_rank"]) for r in got] == [(1, 1), (2, 2)]
    assert got[0]["driver_list"] == "1. job length; 2. loan to income; 3. other debt"
    assert got[1]["driver_list"] == "1. loan size; 2. age; 3. income"
    assert got[1]["top2_shap"] == 0.09


def test_threshold_is_inclusive_and_ties_follow_the_id(spark):
    scored = scored_rows(spark).withColumn("predicted_pd", F.lit(0.30))
    labels = spark.createDataFrame(LABELS, "feature_name string, feature_label string")
    for cap in (500, None):
        got = rows(marts.declined_drivers(scored, labels, Policy(0.30, cap)), "decline_rank")
        assert [r["application_id"] for r in got] == [1, 2, 3]


def test_unlabelled_driver_leaves_a_gap(spark):
    labels = spark.createDataFrame(LABELS[:1] + LABELS[2:], "feature_name string, feature_label string")
    first = rows(marts.declined_drivers(scored_rows(spark), labels, Policy(0.45)), "decline_rank")[0]
    assert first["top2_label"] is None
    assert first["driver_list"] == "1. job length; 3. other debt"


def test_capped_and_uncapped_ranks_agree(spark):
    scored = registry.stage_predictions(spark, SMALL)
    labels = label_dictionary(spark)
    capped = marts.declined_drivers(scored, labels, Policy(decline_sample_size=10**6))
    uncapped = marts.declined_drivers(scored, labels, Policy(decline_sample_size=None))
    assert capped.count() > 100
    assert capped.exceptAll(uncapped).isEmpty() and uncapped.exceptAll(capped).isEmpty()


def test_top_drivers_order_sign_and_ties(spark):
    values = [0.0] * len(FEATURES)
    values[2], values[4], values[5], values[7] = 0.25, -0.5, 0.25, 1.5
    scores = spark.createDataFrame(
        [(1, 0.4, values), (2, 0.4, [-0.3 - i for i in range(len(FEATURES))])],
        "application_id bigint, predicted_pd double, contributions array<double>",
    )
    first, second = rows(scorecard.top_drivers(scores), "application_id")
    assert [first[f"top{i}_feature"] for i in (1, 2, 3)] == [FEATURES[7], FEATURES[2], FEATURES[5]]
    assert [first[f"top{i}_shap"] for i in (1, 2, 3)] == [1.5, 0.25, 0.25]
    assert [second[f"top{i}_feature"] for i in (1, 2, 3)] == FEATURES[:3]
    assert [second[f"top{i}_shap"] for i in (1, 2, 3)] == [-0.3, -1.3, -2.3]


def test_terms_add_up_to_the_score(spark):
    got = registry.linear_scores(spark, SMALL)
    total = sum((F.col(f"term_{f}") for f in FEATURES), F.lit(scorecard.DEFAULT_SCORECARD.intercept))
    gap = F.abs(1 / (1 + F.exp(-total)) - F.col("predicted_pd"))
    assert got.agg(F.max(gap)).first()[0] < 1e-5
