"""Language identification: gradient, held-out accuracy, odd rows."""

import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditweave.llm import language_id as li
from creditweave.llm.common import documents


def test_gradient_through_time():
    net = li.Network(["a", "b", "c"], 4, 1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data = np.array([[1, 2, 3, 2], [2, 2, 1, 5]], np.uint8)
    target, weight = np.array([0, 2]), np.array([0.7, 0.3])
    _, grads = net.gradients(data, target, weight)
    for name, at in [("in_ahead", (2, 3)), ("in_back", (2, 9)), ("state_ahead", (1, 5)), ("state_back", (3, 10)), ("out", (5, 1)), ("bias", (2,))]:
        values = []
        for step in (1e-2, -1e-2):
            net.weights[name][at] += step
            values.append(net.gradients(data, target, weight)[0])
            net.weights[name][at] -= step
        assert (values[0] - values[1]) / 2e-2 == pytest.approx(grads[name][at], rel=0.02, abs=2e-4)


def test_pooling_is_the_mean_over_all_bytes():
    params = li.Params(cache_size=5)
    net = li.Network(["a", "b"], 4, 1)
    texts = ["one two", "x" * 100, "two one two three four five six", "é"]
    got = li.Labeller(net, params).pool(texts)
    for text, p in zip(texts, got):
        parts = li.segments(text, params.longest_segment)
        rows = [net.label(np.frombuffer(s, np.uint8)[None])[:, 0] for s in parts]
        assert p == pytest.approx(np.concatenate(rows).mean(axis=0), abs=1e-5)


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = li.identify(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_only_text_is_read_for_a_prediction(spark):
    params = li.Params(epochs=2, sample_segments=300)
    rows = [(k, "the and of with" if k % 2 else "der die und das", "en" if k % 2 else "de", "s") for k in range(60)]
    odd = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "123 !!", None, "s"), (103, "the", None, None), (None, "der", "de", "s")]
    schema = "doc_id long, text string, lang string, score string"
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows + odd + [rows[0]], schema), params).collect()}
    assert [got[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and got[103].lang_pred == "en"
    assert not got[None].held_out
    bare = spark.createDataFrame(rows[:3], schema).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in li.identify(bare, params).collect()} == {("und", 0.0)}
    assert li.identify(bare.limit(0), params).collect() == []


def test_only_letters_make_a_text_known_and_signs_do_not(spark):
    rows = [(k, "the and of with" if k % 2 else "der die und das", "en" if k % 2 else "de") for k in range(60)]
    signs = {100: "½ ² ①", 101: "Ⅷ ⅓ _ ٣ 7", 102: "ª", 103: "日", 104: "\u0301"}
    df = spark.createDataFrame(rows + [(k, t, None) for k, t in signs.items()], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in li.identify(df, li.Params(epochs=2)).collect()}
    assert [got[k].lang_pred == "und" for k in signs] == [True, True, False, False, True]
    assert got[100].score == 0


def test_a_rare_language_is_learnt(spark):
    """One row in three thousand, with segments rarer than any of the hot language's."""
    rng = np.random.default_rng(5)
    vocabulary = ["the", "and", "of", "with", "house", "which", "there", "would", "could", "river"]
    rows = [(k, " ".join(rng.choice(vocabulary, 12)), "en") for k in range(3000)]
    rare = "żółć gęślą jaźń zażółć źdźbło ślą ęąś łódź"
    rows += [(3001, f"{rare} {rare}", "pl"), (9001, "zażółć gęślą źdźbło łódź", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in li.identify(df, li.Params(sample_rows=100, sample_segments=200), held_out=F.col("doc_id") > 9000).collect()}
    assert got[9001].lang_pred == "pl" and {got[k].lang_pred for k in range(3000)} == {"en"}


def test_labels_equal_the_network_s_on_every_document(spark):
    """Each text once more, without cache, chunks or workers."""
    docs = documents(spark, "/root/testdata/sf0.001")
    params = li.Params(epochs=3, cache_size=40, chunk_bytes=3000)
    learnt = docs.where("lang is not null and text is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    net = li.train(li.training_examples(learnt, params, "doc_id", "text", "lang"), params)
    got = {r.doc_id: r for r in li.identify(docs, params).collect()}
    for row in docs.collect():
        mine = got[row.doc_id]
        if not any(unicodedata.category(c).startswith("L") for c in row.text or ""):
            assert (mine.lang_pred, mine.score) == ("und", 0.0)
            continue
        each = [net.label(np.frombuffer(s, np.uint8)[None])[:, 0] for s in li.segments(row.text, params.longest_segment)]
        p = np.concatenate(each).mean(axis=0)
        assert mine.lang_pred == net.languages[int(p.argmax())] or np.sort(p)[-1] - np.sort(p)[-2] < 1e-4
        assert mine.score == pytest.approx(p.max(), abs=1e-4)
