"""The pipeline stage by stage against brute force on a small table."""

import pytest
from test_exact_dedup import plain as plain_copies
from test_mixing import plain as plain_mix
from test_packing import verify
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from creditweave.llm import language_id, mixing
from creditweave.llm.common import documents

FOLDER = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_have_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "mixing", "packing"]


def test_every_stage_on_its_own_input(spark):
    docs = documents(spark, FOLDER)
    extra = spark.createDataFrame(
        [(90_001, None, "en", "a", 0), (90_002, "12 34", "en", "a", 5), (90_003, "", None, None, 0)], docs.schema
    )
    given = docs.unionByName(extra)
    stage = dict(corpus_pipeline.STAGES)
    first = stage["language_id"](spark, given, FOLDER)
    assert first.columns == docs.columns
    labels = by_id(language_id.identify(given))
    kept = by_id(first)
    assert set(kept) == {k for k, r in labels.items() if r.lang_pred != "und" and r.score >= 0.4}
    assert len(kept) >= 0.97 * docs.count() and not {90_001, 90_002, 90_003} & set(kept)
    whole = by_id(given)
    assert all(whole[k] == r for k, r in kept.items())

    second = stage["exact_dedup"](spark, given, FOLDER)
    decided = plain_copies([(k, r.text) for k, r in whole.items()])
    unique = by_id(second)
    assert second.columns == docs.columns and set(unique) == {d[0] for d in decided if d[3]}

    third = stage["simhash"](spark, given, FOLDER)
    roots = plain_components({k: plain_fingerprint(r.text) for k, r in whole.items()})
    assert third.columns == docs.columns and set(by_id(third)) == set(roots.values())

    fourth = stage["mixing"](spark, given, FOLDER)
    ratio, _, _, _ = plain_mix([(k, r.text, r.lang, r.source) for k, r in whole.items()])
    draws = {r.doc_id: r.u for r in given.select("doc_id", mixing.draw(given.doc_id, mixing.SEED).alias("u")).collect()}
    filled = [k for k, r in whole.items() if (r.text or "").split()]
    largest = max(ratio[k] for k in filled)
    drawn = {k for k in whole if draws[k] < ratio[k] / largest or k not in filled and ratio[k] == 1.0}
    assert fourth.columns == docs.columns and set(by_id(fourth)) == drawn

    assert verify(stage["packing"](spark, given, FOLDER).collect(), {k: r.text for k, r in whole.items()}) < 0.05


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in documents(spark, FOLDER).collect()}
    kept = {r.doc_id for r in got}
    # Sampling to targets alone keeps about a third of the rows.
    assert 0.2 * len(texts) < len(kept) < len(texts)
    verify(got, {k: texts[k] for k in kept})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_and_odd_tables(spark, name, stage):
    schema = documents(spark, FOLDER).schema
    assert stage(spark, spark.createDataFrame([], schema), FOLDER).collect() == []
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "the the", "en", None, 7), (1, "the the", "en", None, 7)], schema
    ).selectExpr("*", "1 as score", "'x' as row")
    got = stage(spark, odd, FOLDER)
    if name == "packing":
        assert {r.doc_id for r in got.collect()} == {None, 1}
    else:
        assert got.columns == odd.columns
        want = {"language_id": [1, 1], "exact_dedup": [None, 1], "simhash": [None, 1, 1], "mixing": [None, 1, 1]}[name]
        assert sorted((r.doc_id for r in got.collect()), key=str, reverse=True) == sorted(want, key=str, reverse=True)
