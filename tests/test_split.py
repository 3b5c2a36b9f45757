"""Stratified hash splits: exact, disjoint, and the same on any partitioning."""

from math import ceil

import pytest
from pyspark.sql import functions as F

from creditweave.operators import split


def people(spark, n=5000):
    return spark.range(n).select(
        F.col("id").alias("application_id"), (F.col("id") % 13 == 0).cast("int").alias("is_default")
    )


def test_sizes_are_exact_and_stratified(spark):
    df = split.holdout_split(people(spark, 5003))
    n = {(r["fold"], r["is_default"]): r["count"] for r in df.groupBy("fold", "is_default").count().collect()}
    hits = len(range(0, 5003, 13))
    test = sum(v for (f, _), v in n.items() if f != "train")
    assert test == ceil(0.2 * 5003) and sum(n.values()) == 5003
    assert abs(n["calibration", 1] + n["evaluation", 1] - 0.2 * hits) <= 1
    assert n["evaluation", 0] + n["evaluation", 1] == ceil(0.5 * test)


def test_order_and_partitioning_do_not_matter(spark):
    df = people(spark)
    one = split.holdout_split(df.coalesce(1))
    other = split.holdout_split(df.orderBy(F.rand(3)).repartition(11))
    assert one.exceptAll(other).isEmpty() and one.count() == other.count()


def test_salt_changes_the_rows(spark):
    df = people(spark)
    a, b = (split.select_share(df, 0.2, s).where("selected").select("application_id") for s in ("a", "b"))
    overlap = a.intersect(b).count()
    assert 100 < overlap < 400


def test_unlabelled_rows_are_kept_as_their_own_stratum(spark):
    df = people(spark, 100).withColumn("is_default", F.when(F.col("application_id") >= 10, F.col("is_default")))
    got = split.select_share(df, 0.5, "x")
    assert got.count() == 100
    assert got.where("is_default is null and selected").count() == 5


def test_no_rows(spark):
    assert split.holdout_split(people(spark, 0)).count() == 0


def test_quotas_round_up_and_favour_large_remainders():
    assert split.quotas({0: 282686, 1: 24825}, 0.2) == {0: 56538, 1: 4965}
    assert split.quotas({0: 1, 1: 1}, 0.5) in ({0: 1, 1: 0}, {0: 0, 1: 1})


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_nothing_or_everything(spark, share):
    got = split.select_share(people(spark, 50), share, "x")
    assert got.where("selected").count() == 50 * share


def test_growing_prefixes_select_the_same_rows(spark, monkeypatch):
    def chosen():
        rows = split.select_share(people(spark, 3000), 0.3, "s").where("selected")
        return sorted(r[0] for r in rows.select("application_id").collect())

    usual = chosen()
    monkeypatch.setattr(split, "DIGITS", 1)
    monkeypatch.setattr(split, "ORDERED_ROWS", 3)
    assert chosen() == usual
