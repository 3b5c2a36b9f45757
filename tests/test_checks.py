"""Each check returns exactly the offending rows."""

import math

import pytest
from conftest import rows

from creditweave.operators import checks
from creditweave.plans import catalogue
from creditweave.plans.catalogue import CATALOGUE
from creditweave.sources.schemas import CONTRACTS, contract, struct


def test_not_null_reports_every_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 1.0, "y"), (3, None, None)], "id int, a double, b string")
    got = [tuple(r.values()) for r in rows(checks.not_null(df, "id", ["a", "b"]), "id", "column_name")]
    assert got == [(1, "a"), (3, "a"), (3, "b")]


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [(1, 2)]


def test_accepted_values_lets_nulls_pass(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, None)], "id int, v int")
    assert [tuple(r) for r in checks.accepted_values(df, "id", "v", [0, 1]).collect()] == [(3, 2)]


def test_accepted_range_is_closed_maybe_open_ended_and_rejects_nan(spark):
    df = spark.createDataFrame(
        [(1, 0.0), (2, 1.0), (3, -0.1), (4, 1.1), (5, None), (6, float("nan"))], "id int, v double"
    )
    both = rows(checks.accepted_range(df, "id", {"v": (0, 1)}), "id")
    assert [r["id"] for r in both] == [3, 4, 6]
    low = rows(checks.accepted_range(df, "id", {"v": (0, None)}), "id")
    assert [r["id"] for r in low] == [3, 6]


def test_orphans_counts_rows_and_ignores_null_keys(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert [tuple(r) for r in checks.orphans(child, "k", parent, "id").collect()] == [(7, 2)]


def test_contract_compares_names_and_types(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, d int")
    got = rows(checks.contract(df, "a bigint, b string, c double"), "column_name")
    assert [tuple(r.values()) for r in got] == [
        ("a", "bigint", "int", 1),
        ("c", "double", None, 1),
        ("d", None, "int", 1),
    ]
    assert checks.contract(df, df.schema).isEmpty()


def test_contracts_hold_the_declared_columns():
    assert len(struct(CONTRACTS["applications"])) == 15
    assert len(struct(CONTRACTS["payments"])) == 11
    assert all(f.metadata.get("comment") for f in contract("applications"))
    assert all(f.metadata.get("comment") for f in contract("payments"))


def test_gate_names_the_check_and_counts(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(checks.CheckFailed, match="keys: 1 offending") as failure:
        checks.require_empty("keys", checks.unique(df, "k"))
    assert failure.value.rows == 1
    checks.require_empty("keys", checks.unique(df.distinct(), "k"))


def test_row_rules_are_counted_together(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 0.5)], "a int, b double")
    rules = {"a not null": checks.is_missing("a"), "b range": checks.outside("b", 0, 1), "a accepted": checks.not_accepted("a", [1, 3])}
    with pytest.raises(checks.CheckFailed, match="t a not null, b range: 2 offending"):
        checks.require_rows("t", df, rules)
    checks.require_rows("t", df.where("a = 3"), rules)


def test_content_sees_every_difference_but_order(spark):
    rows_ = [(1, None, "x"), (1, None, "x"), (None, 1, "x"), (2, 3, None)]
    make = lambda data: spark.createDataFrame(data, "a int, b int, c string")
    one = checks.content(make(rows_).repartition(3))
    assert one == checks.content(make(rows_[::-1])) == checks.content(make(rows_).select("c", "a", "b"))
    others = [rows_[1:], rows_ + rows_[:1], [(None, 1, "x")] + rows_[1:], [(1, None, ""), *rows_[1:]], [(1, 1, "x")] + rows_[1:]]
    assert all(checks.content(make(o)) != one for o in others)
    assert checks.content(make(rows_).where("false")) == (0, None, None)
    assert checks.changed_rows(make(rows_), make(rows_[::-1])) == 0
    assert checks.changed_rows(make(rows_), make(rows_[1:] + [(9, 9, "z")])) == 2


def test_rules_are_counted_while_rows_are_written(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(1, None, 0.5), (2, 7, 1.5), (3, 0, None), (4, 0, math.nan)], "id int, v int, x double")
    rules = {("a", "v"): checks.is_missing("v"), ("b", "v"): checks.not_accepted("v", [0, 1]), ("c", "x"): checks.outside("x", 0, 1)}
    found = checks.write_observed(df.repartition(3).mapInArrow(tally, df.schema), f"{folder}/t", rules)
    assert found == {("a", "v"): 1, ("b", "v"): 1, ("c", "x"): 2}
    assert seen.value == 4 and spark.read.parquet(f"{folder}/t").count() == 4
    assert checks.write_observed(df, f"{folder}/u", {}) == {}


def test_all_keys_are_counted_in_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (None, "b", 6), (None, "b", 7), (2, None, None)], "k int, s string, u int")
    assert checks.repeated_keys(df, ("k", "s", "u")) == {"k": 1, "s": 1, "u": 1}
    assert checks.repeated_keys(df, ("k",)) == {"k": 1} and checks.repeated_keys(df, ()) == {}
    assert checks.repeated_keys(df.where("false"), ("k", "s")) == {"k": 0, "s": 0}


def test_every_declared_column_is_one_of_its_table():
    for name, declared in CATALOGUE.items():
        if name in CONTRACTS:
            columns = set(contract(name).names)
            used = {c for _, c in declared.rules()} | set(declared.unique) | set(declared.known)
            assert used <= columns


def test_keys_are_counted_in_shares(spark):
    df = spark.createDataFrame([(i % 40, f"s{i}" if i else None, None) for i in range(60)], "k int, s string, u int")
    assert checks.repeated_keys(df, ("k", "s", "u"), parts=7) == checks.repeated_keys(df, ("k", "s", "u")) == {"k": 20, "s": 0, "u": 0}


def test_catalogue_drops_tables_that_are_checked(spark, folder, monkeypatch):
    """without ``keep`` a table lies on disk only until its last check, and the counts are the same."""
    from pathlib import Path

    from creditweave.settings import ID

    def frame(name, rows):
        columns = ["bureau_credit_id", ID, "credit_status"] if name == "stage_credits" else contract("applications").names
        return spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))

    mart = len(contract("applications").names)
    predictions = spark.createDataFrame([(1, 0.5, "x"), (2, 2.0, None), (2, 0.1, "x")], f"{ID} int, predicted_pd double, top1_feature string")
    credits = frame("stage_credits", [(1, 1, 1), (1, None, 1), (2, 2, None)])
    frames = {"stage_credits": credits, "stage_predictions": predictions, "applications": frame("a", [(1,) * mart, (3,) * mart])}
    there, write = [], catalogue.write_checked
    monkeypatch.setattr(
        catalogue, "write_checked", lambda name, df, path: there.append(sorted(p.name for p in Path(path).parent.glob("*"))) or write(name, df, path)
    )
    kept = [tuple(r) for r in catalogue.run_catalogue(spark, frames, f"{folder}/kept").collect()]
    assert there.pop() == ["stage_credits", "stage_predictions"] and len(list(Path(f"{folder}/kept").glob("*"))) == 3
    monkeypatch.setattr(catalogue, "shares", lambda spark, rows: rows)
    there.clear()
    gone = [tuple(r) for r in catalogue.run_catalogue(spark, frames, f"{folder}/gone", keep=False).collect()]
    assert there == [[], [], ["stage_predictions"]] and not list(Path(f"{folder}/gone").glob("*"))
    assert kept == gone
    assert {("stage_credits", "unique", "bureau_credit_id", 1), ("stage_predictions", "relationships", ID, 1)} <= set(kept)
