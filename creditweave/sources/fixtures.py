"""The given star-schema tables, mapped to the bronze tables.

Orders with their customers act as applications; line items act as earlier
credits and as payments. Amounts are carried as whole cents until the last
step, so that results do not depend on the order of additions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creditweave.functions.numbers import round_to
from creditweave.sources.schemas import BRONZE, struct

# The day all offsets count from, and the physical schemas.
AS_OF = "2002-01-01"
SCHEMAS = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint,
        l_linenumber int, l_quantity double, l_extendedprice double,
        l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp_ntz""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int,
        c_acctbal double, c_mktsegment string""",
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(struct(SCHEMAS[name])).parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    return F.floor(F.col(name) * 100 + 0.5)


def _day(column: Column) -> Column:
    return F.datediff(column.cast("date"), F.lit(AS_OF).cast("date"))


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType) for f in struct(BRONZE[table])])


def application_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    customer = given(spark, sf_dir, "customer")
    who = F.col("o_custkey")
    df = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("sk_id_curr"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
        F.col("o_orderpriority").alias("name_contract_type"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("code_gender"),
        F.when(who % 3 == 0, "Y").otherwise("N").alias("flag_own_car"),
        F.when(who % 2 == 0, "Y").otherwise("N").alias("flag_own_realty"),
        (F.col("c_nationkey") % 4).alias("cnt_children"),
        F.when(who % 50 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("amt_income_total"),
        F.col("o_totalprice").alias("amt_credit"),
        round_to(F.col("o_totalprice") * 0.05, 2).alias("amt_annuity"),
        F.col("o_totalprice").alias("amt_goods_price"),
        F.col("c_mktsegment").alias("name_income_type"),
        F.when(who % 4 == 0, "higher").otherwise("secondary").alias("name_education_type"),
        F.when(who % 5 < 3, "married").otherwise("single").alias("name_family_status"),
        (-(7000 + (who * 37) % 18000)).alias("days_birth"),
        F.when(who % 10 == 0, 365243).otherwise(-((who * 13) % 12000)).alias("days_employed"),
    )
    return _conform(df, "application_train")


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    price, discount = _hundredths("l_extendedprice"), _hundredths("l_discount")
    df = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sk_id_curr"),
        F.md5(
            F.concat_ws(
                "|",
                "l_orderkey",
                "l_suppkey",
                "l_linenumber",
                F.col("l_shipdate").cast("date").cast("string"),
                F.col("l_extendedprice").cast("string"),
            )
        ).alias("sk_id_bureau"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Closed").alias("credit_active"),
        F.col("l_returnflag").alias("credit_type"),
        _day(F.col("l_shipdate")).alias("days_credit"),
        F.when(returned, F.col("l_quantity").cast("int")).otherwise(0).alias("credit_day_overdue"),
        F.col("l_extendedprice").alias("amt_credit_sum"),
        (price * (100 - discount) / 10000.0).alias("amt_credit_sum_debt"),
        F.when(returned, price * discount / 10000.0).otherwise(0.0).alias("amt_credit_sum_overdue"),
    )
    return _conform(df, "bureau")


def installments_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lineitem = given(spark, sf_dir, "lineitem")
    price, tax = _hundredths("l_extendedprice"), _hundredths("l_tax")
    df = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("sk_id_prev"),
        F.col("l_orderkey").alias("sk_id_curr"),
        F.col("l_suppkey").alias("num_instalment_version"),
        F.col("l_linenumber").alias("num_instalment_number"),
        (_day(F.col("o_orderdate")) + 60).alias("days_instalment"),
        _day(F.col("l_shipdate")).alias("days_entry_payment"),
        (F.floor((price * (100 + tax) + 50) / 100.0) / 100.0).alias("amt_instalment"),
        F.col("l_extendedprice").alias("amt_payment"),
    )
    return _conform(df, "installments_payments")


BRONZE_BUILDERS = {
    "application_train": application_train,
    "bureau": bureau,
    "installments_payments": installments_payments,
}
