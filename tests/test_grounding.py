"""Reasons, prompts and the citation gate."""

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from creditweave.operators import grounding, reasons
from creditweave.plans import registry
from creditweave.sources.tables import LABELS, label_dictionary

DECLINES = "application_id bigint, adverse_action_reason string, top1_label string, top2_label string, top3_label string"
DICTIONARY = ["age", "past-due amount", "loan (size)", "income", "job length", "C++ skills"]


def labels(spark, phrases=DICTIONARY):
    return spark.createDataFrame([(f"f{i}", p) for i, p in enumerate(phrases)], "feature_name string, feature_label string")


def declines(spark):
    return spark.createDataFrame(
        [
            (1, "Declined for Age, income and job length.", "age", "income", "job length"),
            (2, "Your AGE and the past-due amount count.", "income", "job length", "past-due amount"),
            (3, "A teenager's wages; incomes vary; agelessness.", "age", "income", "job length"),
            (4, "Because of loan (size) and income", "income", "job length", "age"),
            (5, "Nothing is cited.", "age", None, "income"),
            (6, "income and age", "age", None, "job length"),
        ],
        DECLINES,
    )


EXPECTED = [
    (2, "age"),
    (5, grounding.NO_LABEL),
    (6, grounding.NO_LABEL),
    (6, "income"),
]


def gate(spark, phrases=DICTIONARY):
    lowered = grounding._lowered(declines(spark))
    return {r["application_id"]: r["cited"] for r in grounding.cited_labels(lowered, labels(spark, phrases)).collect()}


def test_gate_lists_foreign_citations(spark):
    got = [tuple(r.values()) for r in rows(
        grounding.ungrounded_citations(declines(spark), labels(spark)), "application_id", "foreign_label_cited"
    )]
    assert got == EXPECTED


def test_dictionaries_of_any_size_give_the_same_citations(spark):
    few = gate(spark)
    for size in (3, 300):
        assert gate(spark, DICTIONARY + [f"other {i} phrase" for i in range(size)]) == few


def test_symbols_in_labels_are_taken_literally(spark):
    reasons_ = spark.createDataFrame([(1, "owes a++b and x.y and q(r)s today", None, None, None)], DECLINES)
    lowered = grounding._lowered(reasons_)
    for padding in (0, 300):
        phrases = ["a++b", "x.y", "q(r)s", "xzy", *[f"w{i}" for i in range(padding)]]
        assert grounding.cited_labels(lowered, labels(spark, phrases)).first()["cited"] == ["a++b", "q(r)s", "x.y"]


def test_a_label_without_a_word_is_refused(spark):
    with pytest.raises(Exception, match="label without a word"):
        gate(spark, ["++"])


def test_phrase_ending_in_a_symbol_needs_a_word_next(spark):
    # \b after a symbol asks for a word character, so this phrase never matches
    # before a blank, on either path.
    assert gate(spark)[4] == ["income"]


def test_metrics(spark):
    got = grounding.grounding_metrics(declines(spark).where("application_id < 5"), labels(spark)).first()
    assert tuple(got) == (4, 1.25, 3, 1)


def test_template_reasons_are_grounded(spark):
    found = grounding.ungrounded_citations(registry.decline_reasons(spark, SMALL), label_dictionary(spark))
    assert found.isEmpty()
    metrics = grounding.grounding_metrics(registry.decline_reasons(spark, SMALL), label_dictionary(spark)).first()
    assert metrics["avg_own_drivers_cited"] == 3.0
    assert metrics["reasons_citing_any_driver"] == metrics["n_reasons"] > 0


def test_no_built_in_phrase_holds_another():
    phrases = list(LABELS.values())
    assert len(set(phrases)) == 13
    assert not [(a, b) for a in phrases for b in phrases if a != b and a in b]


def test_own_writer_sees_prompts_in_batches(spark):
    drivers = registry.declined_drivers(spark, SMALL)
    written = reasons.with_reason(drivers, lambda prompts: prompts.str.upper())
    row = written.first()
    assert row["driver_list"].upper() in row["adverse_action_reason"]
    assert written.count() == drivers.count()


def test_no_product_of_reasons_and_labels(spark):
    found = grounding.ungrounded_citations(declines(spark), labels(spark))
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_writer_sees_each_prompt_once(spark):
    """Calls do not grow with applicants; rows without a prompt have no text."""
    seen = spark.sparkContext.accumulator(0)

    def write(prompts):
        seen.add(len(prompts))
        return "because: " + prompts

    lists = ["a; b; c", "b; a; c", "c", None]
    for n in (40, 4000):
        before = seen.value
        df = spark.range(n).select(
            F.col("id").alias("application_id"), F.element_at(F.array(*[F.lit(x) for x in lists]), (F.col("id") % 4 + 1).cast("int")).alias("driver_list")
        )
        got = reasons.with_reason(df.repartition(6), write).collect()
        assert seen.value - before == 3 and len(got) == n
        assert all((r.adverse_action_reason is None) == (r.driver_list is None) for r in got)
        assert all(r.driver_list in r.adverse_action_reason for r in got if r.driver_list)
