"""Conformed columns on hand-written rows."""

import math

from conftest import rows
from pyspark.sql import functions as F

from creditweave.functions import numbers
from creditweave.operators import checks, staging
from creditweave.sources import schemas


def bronze(spark, table, *records):
    schema = schemas.struct(schemas.BRONZE[table])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in records], schema)


def test_not_employed_marker_becomes_null(spark):
    raw = bronze(
        spark,
        "application_train",
        {"sk_id_curr": 1, "target": 1, "days_birth": -3653, "days_employed": 365243},
        {"sk_id_curr": 2, "target": 0, "days_birth": -1461, "days_employed": -1461},
    )
    staged = staging.stage_applications(raw)
    got = rows(staged.select("application_id", "is_default", "age_years", "employment_years"), "application_id")
    assert got == [
        {"application_id": 1, "is_default": 1, "age_years": 10, "employment_years": None},
        {"application_id": 2, "is_default": 0, "age_years": 4, "employment_years": 4.0},
    ]


def test_years_equal_decimal_arithmetic(spark):
    days = spark.range(-20000, 20001).select((-F.col("id")).cast("int").alias("d"))
    wrong = days.where(
        (numbers.years_fraction(F.col("d")) != F.expr("cast(-d / 365.25 as double)"))
        | (numbers.years_whole(F.col("d")) != F.expr("cast(-d / 365.25 as int)"))
    )
    assert wrong.count() == 0


def test_unpaid_payment_keeps_nulls_and_a_key(spark):
    raw = bronze(
        spark,
        "installments_payments",
        {"sk_id_prev": 1, "sk_id_curr": 9, "num_instalment_version": 1, "num_instalment_number": 2,
         "days_instalment": -30, "amt_instalment": 100.0},
        {"sk_id_prev": 1, "sk_id_curr": 9, "num_instalment_version": 1, "num_instalment_number": 2,
         "days_instalment": -30, "days_entry_payment": -28, "amt_instalment": 100.0, "amt_payment": 40.5},
    )
    unpaid, part = rows(staging.stage_payments(raw), F.col("payment_amount").asc_nulls_first())
    assert unpaid["payment_shortfall"] is None and unpaid["days_late"] is None
    assert part["payment_shortfall"] == 59.5 and part["days_late"] == 2
    keys = raw.select(
        F.md5(F.lit("1||1||2||_null_||_null_")).alias("a"), F.md5(F.lit("1||1||2||-28||40.5")).alias("b")
    ).first()
    assert (unpaid["payment_id"], part["payment_id"]) == (keys["a"], keys["b"])


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(numbers.safe_divide(F.col("n"), F.col("d"))).collect()]
    assert got == [2.0, None, None, None]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.005] * 100
    sums = {
        spark.createDataFrame([(v,) for v in order], "v double").agg(numbers.exact_sum(F.col("v"))).first()[0]
        for order in (values, values[::-1], sorted(values))
    }
    assert sums == {60.5}


def test_rounding_keeps_nan(spark):
    got = spark.sql("select double('NaN') as x").select(numbers.round_to(F.col("x"), 6)).first()[0]
    assert got != got


def test_staged_columns_match_contract_types(spark):
    empty = {t: bronze(spark, t) for t in schemas.BRONZE}
    payments = staging.stage_payments(empty["installments_payments"])
    assert [(f.name, f.dataType) for f in payments.schema] == [
        (f.name, f.dataType) for f in schemas.contract("payments")
    ]
    assert staging.stage_predictions(empty["pd_predictions"]).columns == [
        f.name for f in schemas.struct(schemas.PD_PREDICTIONS)
    ]
    assert len(staging.stage_credits(empty["bureau"]).columns) == 9
    assert len(staging.stage_applications(empty["application_train"]).columns) == 16


def test_exact_sum_takes_all_or_says_so(spark):
    def total(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "v double")
        return df.agg(numbers.exact_sum(F.col("v"))).first()[0]

    assert total(1e19, 5.0) == 1e19 + 5.0
    assert total(0.00004, 0.00004) == 0.00008
    assert total(None, 2.5) == 2.5 and total(None) is None and total() is None
    for refused in (float("inf"), -float("inf"), float("nan"), 1e20, -3e25):
        assert math.isnan(total(refused, 1.0))
    assert math.isnan(total(*[9e19] * 12))
    df = spark.createDataFrame([(a,) for a in (1e19, None, 0.00004, 1e20, float("inf"), float("nan"))], "v double")
    assert df.where(checks.not_summable("v")).count() == 3
