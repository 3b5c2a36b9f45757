"""Bins, splits, tree growth and the tree table against plain forms."""

import math
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditweave.operators import attribution, feature_bins as fb, histogram_boosting as hb, metrics, tree_table as tt
from creditweave.session import cut_lineage
from creditweave.settings import CATEGORICAL, FEATURES, ID, NUMERIC_FEATURES

KIND = FEATURES.index(CATEGORICAL)


def mart_of(spark, n=2500, seed=11, kinds=("cash", "card", "car")):
    """A mart whose target depends on a few features and on a missing one."""
    rng = np.random.default_rng(seed)
    columns = {f: rng.normal(50, 15, n).round(3) for f in NUMERIC_FEATURES}
    gone = rng.random(n) < 0.3
    kind = rng.choice([*kinds, ""], n)
    odds = 0.08 * (columns["income_total"] - 50) - 0.1 * (columns["credit_amount"] - 50) + np.where(gone, 2.0, 0.0) + (kind == kinds[0])
    target = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    data = []
    for i in range(n):
        values = {f: float(columns[f][i]) for f in NUMERIC_FEATURES}
        values["employment_years"] = None if gone[i] else values["employment_years"]
        values["age_years"] = math.nan if i % 50 == 0 else values["age_years"]
        data.append((i, int(target[i]), str(kind[i]) or None, *values.values()))
    schema = f"{ID} bigint, is_default int, {CATEGORICAL} string, " + ", ".join(f"{f} double" for f in NUMERIC_FEATURES)
    return cut_lineage(spark.createDataFrame(data, schema).repartition(4))


@pytest.fixture(scope="module")
def mart(spark):
    return mart_of(spark)


SMALL = hb.Params(max_trees=12, learning_rate=0.3, leaves=12, depth=None)


@pytest.fixture(scope="module")
def fitted(mart):
    return hb.fit_boosted(mart, SMALL)


# -- bins -------------------------------------------------------------------------


def test_cells_are_lower_bounds_by_leading_bits(spark):
    rng = np.random.default_rng(1)
    x = [0.0, -0.0, 1e-310, 5e-324, 1.0, 2.0, 4.0, -1.0, -2.0, 127.0, 128.0, 129.0, 255.9, 1e299, -1e299, 1e305, math.inf, -math.inf]
    x += [2.0**k for k in range(-60, 61)] + [math.nextafter(2.0**k, 0) for k in range(-60, 61)]
    x += (rng.choice([-1, 1], 500) * np.exp(rng.normal(0, 12, 500))).tolist()
    got = spark.createDataFrame([(v,) for v in x], "x double").select("x", fb.cell(F.col("x")).alias("low")).collect()
    for r in got:
        if abs(r.x) < 1e-300:
            assert r.low == 0
        elif abs(r.x) > 1e300:
            assert r.low == math.copysign(1e300, r.x)
        else:
            step = 2.0 ** (math.frexp(r.x)[1] - 1 - fb.SKETCH_BITS)
            assert r.low == math.floor(r.x / step) * step <= r.x and r.x - r.low < abs(r.x) / 2**fb.SKETCH_BITS


def test_bins_hold_about_equal_shares(spark):
    df = spark.createDataFrame([(float(v),) for v in np.exp(np.random.default_rng(2).normal(0, 2, 20_000))] + [(None,)] * 70, "x double")
    mart = df.select(F.lit("a").alias(CATEGORICAL), *[F.col("x").alias(f) if f == "income_total" else F.lit(1.0).alias(f) for f in NUMERIC_FEATURES])
    found = fb.feature_bins(mart).where("feature = 'income_total'").collect()
    sizes = {r.bin: r.n_rows for r in found}
    assert sizes.pop(0) == 70 and len(sizes) == 63 and sum(sizes.values()) == 20_000
    assert max(sizes.values()) < 2 * 20_000 / 63
    again = fb.feature_bins(mart.repartition(7)).where("feature = 'income_total'").collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert [(r.bin, r.low_edge, r.n_rows) for r in fb.feature_bins(mart).where("feature = 'age_years'").collect()] == [(1, 1.0, 20_070)]


def test_rare_and_missing_categories(spark):
    many = mart_of(spark, 900, kinds=tuple(f"kind {i}" for i in range(90)))
    bins = fb.Bins.of(many)
    assert len(bins.categories) == fb.RARE - 1 and fb.RARE not in bins.categories.values()
    model = hb.fit_boosted(many, hb.Params(max_trees=2, least_rows=3))
    assert tt.tree_scores(many, tt.model_table(spark, model)).where("predicted_pd between 0 and 1").count() == 900


# -- splits and growth ----------------------------------------------------------------


def plain_split(x, g, h, features, params):
    """Every split one by one: (gain, left rows)."""
    best = (hb.LEAST_GAIN, None)
    for j in features:
        values = sorted({b for b in x[:, j].tolist() if b or j == KIND})
        if j == KIND:
            mean = {b: g[x[:, j] == b].sum() / (h[x[:, j] == b].sum() + hb.CATEGORY_SMOOTHING * hb.UNIT) for b in values}
            order = sorted(values, key=lambda b: (mean[b], b))
            sides = [np.isin(x[:, j], order[: t + 1]) for t in range(len(order) - 1)]
        else:
            sides = [(x[:, j] > 0) & (x[:, j] <= t) for t in values]
            if (x[:, j] == 0).any():
                sides += [x[:, j] <= t for t in values]
        for left in sides:
            if min(left.sum(), (~left).sum()) >= params.least_rows:
                gain = sum((g[s].sum() / hb.UNIT) ** 2 / (h[s].sum() / hb.UNIT) for s in (left, ~left)) - (g.sum() / hb.UNIT) ** 2 / (h.sum() / hb.UNIT)
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, left)
    return best


class Local(hb.Fit):
    """A fit over one block, without Spark."""

    def __init__(self, block, params):
        self.block, self.params, self.trees, self.base, self.name, self.passes = block, params, [], 0.0, "local", 0

    def _pass(self, work):
        self.passes += 1
        return work(self.block, np.zeros(len(self.block.x)))


def block_of(rng, n):
    x = rng.integers(0, 9, (n, len(FEATURES))).astype(np.uint8)
    x[:, 2] = rng.integers(1, 64, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 2] / 20.0 - x[:, 4] / 3.0 + (x[:, 0] % 3))))).astype(float)
    return hb.Block(0, x, y, rng.integers(-(2**62), 2**62, n), np.zeros(n, bool))


@pytest.mark.parametrize("seed", range(4))
def test_trees_are_those_of_one_split_at_a_time(seed):
    block = block_of(np.random.default_rng(seed), 700)
    params = hb.Params(row_share=1.0, column_share=1.0, leaves=9, depth=None if seed % 2 else 4, least_rows=15)
    fit = Local(block, params)
    tree = hb.grow(fit, 0, fit.start(0)[0])
    g, h = hb.gradients(np.zeros(700), block.y)
    members = [(np.arange(700), 0)]
    while len(members) < params.leaves:
        found = [plain_split(block.x[m], g[m], h[m], range(len(FEATURES)), params) if d != params.depth else (0, None) for m, d in members]
        i = max(range(len(members)), key=lambda k: found[k][0] if found[k][1] is not None else -1)
        if found[i][1] is None:
            break
        (rows, depth), left = members.pop(i), found[i][1]
        members += [(rows[left], depth + 1), (rows[~left], depth + 1)]
    leaf = tree.leaf_of(block.x)
    got = sorted(tuple(np.flatnonzero(leaf == k).tolist()) for k in np.unique(leaf))
    assert got == sorted(tuple(sorted(m.tolist())) for m, _ in members)
    for k in np.unique(leaf):
        here = leaf == k
        assert tree.value[k] == pytest.approx(-params.learning_rate * g[here].sum() / h[here].sum()) and tree.rows[k] == here.sum()
    assert fit.passes <= 9


def test_shares_of_rows_are_drawn_by_id_and_tree():
    ids = np.random.default_rng(3).integers(-(2**62), 2**62, 50_000)
    one, two = hb.drawn(ids, 42, 0, 0.8), hb.drawn(ids, 42, 1, 0.8)
    assert abs(one.mean() - 0.8) < 0.01 and abs((one & two).mean() - 0.64) < 0.01
    assert hb.drawn(ids, 42, 0, 1.0).all() and np.array_equal(hb.drawn(ids[::-1], 42, 0, 0.8), one[::-1])


def test_auc_of_cells():
    rng = np.random.default_rng(4)
    score, y = rng.integers(0, 50, 400), rng.integers(0, 2, 400)
    cells = np.array([np.bincount(score[y == k], minlength=hb.SCORE_CELLS) for k in (0, 1)])
    pairs = [(a > b) + 0.5 * (a == b) for a in score[y == 1] for b in score[y == 0]]
    assert hb.cell_auc(cells) == pytest.approx(np.mean(pairs))
    assert math.isnan(hb.cell_auc(np.stack([cells[0], 0 * cells[0]])))


def _as_text(model):
    return str([(t.feature.tolist(), t.mask.tolist(), t.left.tolist(), t.value.tolist(), t.rows.tolist()) for t in model.trees])


def test_trees_do_not_depend_on_how_rows_are_dealt(mart, fitted, monkeypatch):
    monkeypatch.setattr(hb, "LOOSE_TREES", 2)  # most trees are broadcast
    for partitions in (1, 7):
        dealt = cut_lineage(mart.repartition(partitions + 1))
        again = hb.fit_boosted(dealt, hb.replace(SMALL, partitions=partitions))
        assert _as_text(again) == _as_text(fitted) and again.watched_auc == fitted.watched_auc


def test_every_tree_is_grown_once_and_the_best_are_kept(mart, monkeypatch):
    grown = []
    monkeypatch.setattr(hb, "grow", lambda fit, number, root, grow=hb.grow: grown.append(number) or grow(fit, number, root))
    model = hb.fit_boosted(mart, hb.Params(max_trees=60, learning_rate=0.9, patience=3))
    assert grown == list(range(len(model.watched_auc)))
    best = len(model.trees) - 1
    assert model.watched_auc[best] == max(model.watched_auc)
    assert len(model.watched_auc) == 60 or len(model.watched_auc) - 1 - best == 3


def test_one_class_and_no_rows(spark, mart):
    same = hb.fit_boosted(mart.withColumn("is_default", F.lit(1)), hb.Params(max_trees=2, patience=1))
    assert tt.tree_scores(mart, tt.model_table(spark, same)).where("predicted_pd between 0 and 1").count() == 2500
    none = hb.fit_boosted(mart.limit(0), hb.Params(max_trees=2))
    assert none.trees == [] and tt.tree_scores(mart, tt.model_table(spark, none)).where("predicted_pd = 0.5").count() == 2500


# -- the table ------------------------------------------------------------------------


def test_the_model_ranks_new_rows_and_learns_where_missing_values_go(spark, mart, fitted):
    fresh = mart_of(spark, 1500, seed=12)
    scored = fresh.join(tt.tree_scores(fresh, tt.model_table(spark, fitted)), ID)
    auc = metrics.auc(metrics.score_counts(scored, "predicted_pd", "is_default")).first()[0]
    assert auc > 0.8
    means = {r.gone: r.p for r in scored.groupBy(F.col("employment_years").isNull().alias("gone")).agg(F.avg("predicted_pd").alias("p")).collect()}
    assert means[True] > means[False] + 0.15


def test_table_scores_are_the_model_s(spark, mart, fitted):
    odd = mart.withColumn(CATEGORICAL, F.when(F.col(ID) % 7 == 0, "boat").otherwise(F.col(CATEGORICAL)))
    odd = odd.withColumn("income_total", F.when(F.col(ID) % 11 == 0, 1e12).when(F.col(ID) % 13 == 0, math.inf).otherwise(F.col("income_total")))
    frame = odd.toPandas()
    x = fitted.bins.number(frame)
    margin = fitted.base + sum(t.value[t.leaf_of(x)] for t in fitted.trees)
    stored = cut_lineage(tt.model_table(spark, fitted))
    got = {r[0]: r[1] for r in tt.tree_scores(odd, stored).collect()}
    assert np.allclose([got[i] for i in frame[ID]], 1 / (1 + np.exp(-margin)), rtol=1e-12)


def test_leaf_formula_is_the_table_of_attribution():
    rng = np.random.default_rng(5)
    for size in range(1, 7):
        shares = rng.uniform(0.05, 0.95, size)
        met = ((np.arange(2**size)[:, None] >> np.arange(size)) & 1).astype(float)
        assert np.abs(tt.shapley(1.7, shares, met) - attribution.shapley_table(1.7, list(shares))).max() < 1e-14


def expected(nodes, tree, row, known, number=0):
    """Mean score of a tree when only the features in ``known`` are given."""
    node = nodes[tree, number]
    if node.feature is None:
        return node.value
    left, right = nodes[tree, node.left], nodes[tree, node.right]
    if node.feature in known:
        v = row[node.feature]
        if v is None or v != v:
            goes = node.missing_left
        else:
            goes = v in node.categories if node.categories is not None else v < node.threshold
        return expected(nodes, tree, row, known, (left if goes else right).node)
    return sum(c.cover / node.cover * expected(nodes, tree, row, known, c.node) for c in (left, right))


def test_contributions_equal_subsets_one_by_one(spark, mart):
    model = hb.fit_boosted(mart, hb.Params(max_trees=3, learning_rate=0.5, leaves=8, depth=None))
    table = cut_lineage(tt.model_table(spark, model))
    nodes = {(r.tree, r.node): r for r in table.collect()}
    trees = {t for t, _ in nodes}
    rows = mart.where(f"{ID} < 60").withColumn(CATEGORICAL, F.when(F.col(ID) == 3, "boat").otherwise(F.col(CATEGORICAL)))
    got = {r[ID]: r for r in tt.tree_contributions(rows, table).collect()}
    base = tt.TreeTable.of(table).base_value()
    for row in rows.collect():
        phi = dict.fromkeys(FEATURES, 0.0)
        for tree in trees:
            used = sorted({n.feature for (t, _), n in nodes.items() if t == tree and n.feature})
            for f in used:
                others = [o for o in used if o != f]
                for size in range(len(used)):
                    weight = factorial(size) * factorial(len(used) - size - 1) / factorial(len(used))
                    for chosen in combinations(others, size):
                        phi[f] += weight * (expected(nodes, tree, row, {*chosen, f}) - expected(nodes, tree, row, set(chosen)))
        mine = got[row[ID]]
        assert np.abs(np.array(mine.contributions) - [phi[f] for f in FEATURES]).max() < 1e-9
        p = mine.predicted_pd
        assert base + sum(mine.contributions) == pytest.approx(math.log(p / (1 - p)))
