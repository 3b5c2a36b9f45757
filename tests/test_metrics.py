"""Ordered metrics against brute force, on rows with ties and hot scores."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from creditweave.operators import calibration, metrics, ordering
from creditweave.session import cut_lineage
from pyspark.sql import functions as F

SCORED = "application_id bigint, predicted_pd double, is_default int, contract_type string"


def frame(spark, scores, labels, slices=None):
    slices = slices or ["a"] * len(scores)
    data = [(i, float(s), int(y), c) for i, (s, y, c) in enumerate(zip(scores, labels, slices))]
    return spark.createDataFrame(data, SCORED)


def brute_auc(scores, labels):
    hit, miss = scores[labels == 1], scores[labels == 0]
    return ((hit[:, None] > miss).sum() + 0.5 * (hit[:, None] == miss).sum()) / (len(hit) * len(miss))


def brute_ks(scores, labels):
    at = np.unique(scores)
    hit, miss = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    return np.abs(
        np.searchsorted(hit, at, "right") / len(hit) - np.searchsorted(miss, at, "right") / len(miss)
    ).max()


def sample(seed, n=2000, hot=0.33):
    """A third of the rows share one score."""
    rng = np.random.default_rng(seed)
    scores = np.round(rng.beta(2, 8, n), 3)
    scores[rng.random(n) < hot] = 0.08
    labels = (rng.random(n) < scores + 0.2).astype(int)
    return scores, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_ks_equal_brute_force(spark, seed):
    scores, labels = sample(seed)
    counts = metrics.score_counts(frame(spark, scores, labels), "predicted_pd", "is_default")
    assert metrics.auc(counts).first()[0] == pytest.approx(brute_auc(scores, labels), abs=1e-6)
    assert metrics.ks(counts).first()[0] == pytest.approx(brute_ks(scores, labels), abs=1e-6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1)), min_size=4, max_size=40))
def test_auc_is_unchanged_by_monotone_maps(spark, data):
    scores = np.array([s / 5 for s, _ in data] + [0.1, 0.9])
    labels = np.array([y for _, y in data] + [0, 1])
    plain = metrics.auc(metrics.score_counts(frame(spark, scores, labels), "predicted_pd", "is_default"))
    mapped = metrics.auc(metrics.score_counts(frame(spark, np.exp(3 * scores), labels), "predicted_pd", "is_default"))
    assert plain.first()[0] == mapped.first()[0] == pytest.approx(brute_auc(scores, labels), abs=1e-6)


def test_one_class_gives_nan(spark):
    counts = metrics.score_counts(frame(spark, [0.1, 0.2], [0, 0]), "predicted_pd", "is_default")
    value = metrics.auc(counts).first()[0]
    assert value != value


def test_slices(spark):
    scores, labels = sample(3)
    slices = ["cash" if i % 3 else "revolving" for i in range(len(scores))]
    slices[-1], labels[-1] = "rare", 1
    got = {
        r["contract_type"]: r
        for r in metrics.slice_metrics(
            frame(spark, scores, labels, slices), "predicted_pd", "is_default", "contract_type"
        ).collect()
    }
    for name in ("cash", "revolving"):
        mine = np.array([s == name for s in slices])
        assert got[name]["n"] == mine.sum()
        assert got[name]["observed_rate"] == pytest.approx(labels[mine].mean(), abs=1e-6)
        assert got[name]["mean_predicted"] == pytest.approx(scores[mine].mean(), abs=1e-6)
        assert got[name]["auc"] == pytest.approx(brute_auc(scores[mine], labels[mine]), abs=1e-6)
    assert got["rare"]["auc"] != got["rare"]["auc"]


@pytest.mark.parametrize("seed", [4, 5])
def test_reliability_uses_interpolated_quantile_edges(spark, seed):
    scores, labels = sample(seed, n=1003)
    counts = metrics.score_counts(frame(spark, scores, labels), "predicted_pd", "is_default")
    edges = np.percentile(scores, np.arange(10, 100, 10))
    assert metrics.quantile_edges(counts, 10) == pytest.approx(list(edges), abs=1e-12)
    bins = np.searchsorted(edges, scores)
    got = {r["bin"]: r for r in metrics.reliability(counts).collect()}
    assert sorted(got) == sorted(set(bins.tolist()))
    for b, r in got.items():
        assert r["n"] == (bins == b).sum()
        assert r["mean_predicted"] == pytest.approx(scores[bins == b].mean(), abs=1e-6)
        assert r["observed_rate"] == pytest.approx(labels[bins == b].mean(), abs=1e-6)


def test_brier(spark):
    df = frame(spark, [0.5, 0.0, 1.0], [1, 0, 0])
    assert metrics.brier(df, "is_default", {"b": "predicted_pd"}).first()[0] == pytest.approx(1.25 / 3, abs=1e-6)


def pooled(scores, labels):
    """Pool-adjacent-violators on unique scores."""
    blocks = []
    for s in np.unique(scores):
        y = labels[scores == s]
        blocks.append([y.mean(), len(y), [s]])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v, w, at = blocks.pop()
            u, x, earlier = blocks.pop()
            blocks.append([(v * w + u * x) / (w + x), w + x, earlier + at])
    return {s: v for v, _, at in blocks for s in at}


def test_isotonic_fit_equals_pooling_and_clips(spark):
    scores, labels = sample(6, n=600)
    df = frame(spark, scores, labels)
    model = calibration.fit_calibrator(df)
    got = {r["predicted_pd"]: r["calibrated_pd"] for r in calibration.calibrate(df, model).collect()}
    want = pooled(scores, labels)
    assert max(abs(got[s] - want[s]) for s in want) < 1e-9
    outside = calibration.calibrate(frame(spark, [-1.0, 2.0], [0, 0]), model).orderBy("predicted_pd").collect()
    assert [r["calibrated_pd"] for r in outside] == pytest.approx([min(want.values()), max(want.values())])


def test_running_totals_equal_one_global_window(spark):
    rng = np.random.default_rng(7)
    data = [(str(g), int(i), int(n)) for i, (g, n) in enumerate(zip(rng.choice(["a", "b", "b"], 5000), rng.integers(0, 9, 5000)))]
    data += [(None, 5000, 3), (None, 5001, 4)]
    df = spark.createDataFrame(data, "g string, i long, n long").repartition(7)
    got = ordering.running_totals(df, [F.col("i").desc()], {"upto": "n"}, ["g"]).collect()
    sums, want = {}, {}
    for g, i, n in sorted(data, key=lambda r: -r[1]):
        sums[g] = sums.get(g, 0) + n
        want[i] = sums[g]
    assert {r["i"]: r["upto"] for r in got} == want


def test_numbering_survives_a_hot_score(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000).alias("pd"))
    got = ordering.numbered(df, [F.col("pd").desc(), F.col("id").asc()], "place").collect()
    want = sorted(((r["pd"], r["id"]) for r in got), key=lambda t: (-t[0], t[1]))
    assert [(r["pd"], r["id"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(1, 3001))


def test_isotonic_fit_of_a_million_scores(spark, monkeypatch):
    """Many ranges, merged in a tree; equal to pooling in one pass."""
    n = 1_000_000
    x = (F.xxhash64("id") % 10_000_019 + 10_000_019) / F.lit(20_000_038.0)
    df = spark.range(n).select(x.alias("predicted_pd"), (F.rand(3) < x * x).cast("int").alias("is_default"))
    df = cut_lineage(df.dropDuplicates(["predicted_pd"]))
    monkeypatch.setattr(ordering, "RANGE_ROWS", 20_000)
    model = calibration.fit_calibrator(df)
    found = sorted(tuple(r) for r in model.collect())
    frame_ = df.toPandas().sort_values("predicted_pd")
    scores, labels = frame_["predicted_pd"].to_numpy(), frame_["is_default"].to_numpy()
    assert len(scores) > 900_000
    want = pooled_blocks(scores, labels)
    assert [(r[0], r[1], r[2]) for r in found] == want
    assert [r[3] for r in found] == [w[0] for w in want[1:]] + [None]


def pooled_blocks(scores, labels):
    """Blocks by pooling neighbours in one pass, in whole numbers."""
    blocks = []
    for s, y in zip(scores.tolist(), labels.tolist()):
        blocks.append([s, s, y, 1])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, hits, rows = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + hits, blocks[-1][3] + rows]
    return [(low, high, hits / rows) for low, high, hits, rows in blocks]


def test_calibration_of_odd_scores_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 3)
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.3, 0), (0.6, 1), (float("nan"), 1), (None, 1), (0.9, None)], "predicted_pd double, is_default int")
    model = calibration.fit_calibrator(df)
    assert sorted(tuple(r)[:3] for r in model.collect()) == [(0.1, 0.1, 0.0), (0.2, 0.3, 0.5), (0.6, 0.6, 1.0)]
    asked = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.15, 0.25, 0.25, 0.45, 7.0, float("nan"), None)], "predicted_pd double")
    got = calibration.calibrate(asked, model).orderBy("predicted_pd").collect()
    assert [r[1] for r in got] == [None, 0.0, 0.0, pytest.approx(0.25), 0.5, 0.5, pytest.approx(0.75), 1.0, None]
    none = calibration.fit_calibrator(df.where("false"))
    assert none.collect() == [] and {r[1] for r in calibration.calibrate(asked, none).collect()} == {None}


def test_values_are_carried_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 40)
    marks = {3, 170, 171, 900}
    df = spark.range(1000).select("id", F.when(F.col("id").isin(*marks), F.col("id")).alias("mark")).repartition(5)
    got = {r.id: r.mark for r in ordering.carried(df, ["id"], "mark").collect()}
    assert got == {i: max((m for m in marks if m <= i), default=None) for i in range(1000)}


@pytest.mark.parametrize("kind", ["uniform", "steep", "ties", "odd"])
def test_top_rows_are_selected_by_counting(spark, monkeypatch, kind):
    rng = np.random.default_rng(8)
    values = {
        "uniform": rng.random(4000),
        "steep": np.exp(rng.normal(0, 40, 4000)) * rng.choice([-1, 1], 4000),
        "ties": rng.integers(0, 3, 4000).astype(float),
        "odd": np.concatenate((rng.random(3990), [math.nan, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e308, -1e308, 5e-324, 2.0])),
    }[kind]
    data = [(i, float(v)) for i, v in enumerate(values)] + [(4000, None)]
    df = cut_lineage(spark.createDataFrame(data, "id long, pd double"))
    monkeypatch.setattr(ordering, "RANGE_ROWS", 300)
    monkeypatch.setattr(ordering, "CELLS", 64)
    place = lambda v: (2, 0) if v is not None and v != v else (1, v) if v is not None else (0, 0)
    want = sorted(data, key=lambda r: (*(-k for k in place(r[1])), r[0]))
    for limit in (1, 900, 5000):
        got = ordering.top_numbered(df, ["pd", "id"], "n", limit).orderBy("n").collect()
        assert [(r.n, r.id) for r in got] == [(i + 1, r[0]) for i, r in enumerate(want[:limit])]
        bound = ordering.last_selected(df, "pd", limit)
        if kind != "ties" and bound is not None and limit <= 900:
            assert df.where(F.isnan("pd") | (F.col("pd") >= bound)).count() <= limit + max(300, limit // 8) + 4
