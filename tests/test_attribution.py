"""Attribution against brute-force Shapley values and the fitted model."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditweave.operators import attribution, boosting
from creditweave.session import cut_lineage
from creditweave.settings import FEATURES, ID


def grow(rng, depth, features, nodes, count=1000):
    """A random tree in the stored node form."""
    node_id = len(nodes)
    node = {"id": node_id, "rawCount": count, "prediction": rng.normal(), "leftChild": -1, "rightChild": -1}
    nodes[node_id] = node
    if depth and count > 4 and rng.random() < 0.9:
        slot = int(rng.integers(features))
        if slot == 0:
            left = rng.choice(4, size=rng.integers(1, 4), replace=False).astype(float).tolist()
            node["split"] = {"featureIndex": 0, "leftCategoriesOrThreshold": left, "numCategories": 4}
        else:
            node["split"] = {"featureIndex": slot, "leftCategoriesOrThreshold": [float(rng.normal())], "numCategories": -1}
        part = int(rng.integers(1, count))
        node["leftChild"] = grow(rng, depth - 1, features, nodes, part)
        node["rightChild"] = grow(rng, depth - 1, features, nodes, count - part)
    return node_id


def conditional(nodes, x, known, node_id=0):
    """Expected value of the tree when only the slots in ``known`` are given."""
    node = nodes[node_id]
    if node["leftChild"] < 0:
        return node["prediction"]
    split = node["split"]
    left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
    slot, bounds = split["featureIndex"], split["leftCategoriesOrThreshold"]
    if slot in known:
        goes_left = x[slot] in bounds if split["numCategories"] >= 0 else x[slot] <= bounds[0]
        return conditional(nodes, x, known, left["id"] if goes_left else right["id"])
    return sum(c["rawCount"] / node["rawCount"] * conditional(nodes, x, known, c["id"]) for c in (left, right))


def brute(nodes, x, features):
    phi = np.zeros(features)
    for f in range(features):
        others = [g for g in range(features) if g != f]
        for size in range(features):
            weight = factorial(size) * factorial(features - size - 1) / factorial(features)
            for chosen in combinations(others, size):
                phi[f] += weight * (conditional(nodes, x, {*chosen, f}) - conditional(nodes, x, set(chosen)))
    return phi


@pytest.mark.parametrize("seed", range(8))
def test_leaf_tables_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    features, nodes = 5, {}
    grow(rng, 5, features, nodes)
    leaves = attribution.tree_leaves(nodes, 1.0)
    x = np.column_stack([rng.integers(0, 4, 20).astype(float), rng.normal(size=(20, features - 1))])
    got = attribution.contributions(x, leaves, list(range(features)), features)
    want = np.array([brute(nodes, row, features) for row in x])
    assert np.abs(got - want).max() < 1e-12
    margins = np.array([conditional(nodes, row, set(range(features))) for row in x])
    assert np.abs(got.sum(axis=1) + attribution.base_value(leaves) - margins).max() < 1e-12


@pytest.fixture(scope="module")
def fitted(spark):
    """A mart whose target depends on a few features and has missing values."""
    rng = np.random.default_rng(11)
    n = 1500
    columns = {f: rng.normal(50, 15, n).round(3) for f in FEATURES[1:]}
    odds = 0.08 * (columns["income_total"] - 50) - 0.1 * (columns["credit_amount"] - 50)
    gone = rng.random(n) < 0.3
    odds = odds + np.where(gone, 2.0, 0.0)
    target = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    kinds = rng.choice(["cash", "card", "car"], n)
    data = []
    for i in range(n):
        values = [float(columns[f][i]) for f in FEATURES[1:]]
        if gone[i]:
            values[FEATURES.index("employment_years") - 1] = None
        data.append((i, int(target[i]), str(kinds[i]), *values))
    schema = "application_id bigint, is_default int, contract_type string, " + ", ".join(f"{f} double" for f in FEATURES[1:])
    mart = cut_lineage(spark.createDataFrame(data, schema).repartition(4))
    encoder, model = boosting.fit_boosted(mart, boosting.BoostingParams(max_trees=6, depth=4, learning_rate=0.3))
    return mart, encoder, model


def test_contributions_add_up_to_the_model_score(spark, fitted):
    mart, encoder, model = fitted
    base = attribution.base_value(attribution.model_leaves(spark, model))
    explained = attribution.boosted_contributions(mart, encoder, model)
    total = F.aggregate("contributions", F.lit(base), lambda a, b: a + b)
    scored = model.transform(boosting.encode(mart, encoder)).select(ID, vector_to_array("probability")[1].alias("p"))
    gap = F.abs(1 / (1 + F.exp(-total)) - F.col("p"))
    assert explained.join(scored, ID).agg(F.max(gap)).first()[0] < 1e-9
    assert explained.count() == mart.count()


def test_signal_features_lead(spark, fitted):
    mart, encoder, model = fitted
    explained = attribution.boosted_contributions(mart, encoder, model)
    weight = explained.select([F.avg(F.abs(F.col("contributions")[i])).alias(f) for i, f in enumerate(FEATURES)]).first()
    leading = sorted(FEATURES, key=lambda f: -weight[f])[:3]
    assert set(leading) == {"income_total", "credit_amount", "employment_years"}


def test_unseen_category_is_scored(spark, fitted):
    mart, encoder, model = fitted
    odd = mart.limit(5).withColumn("contract_type", F.when(F.col(ID) % 2 == 0, "boat"))
    assert boosting.boosted_scores(odd, encoder, model).where("predicted_pd between 0 and 1").count() == 5


def test_patience():
    assert boosting.best_iteration([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert boosting.best_iteration([3.0, 2.0, 2.5, 2.4, 1.0], patience=3) == 5
    assert boosting.best_iteration([1.0], patience=50) == 1


def test_the_model_does_not_depend_on_how_rows_come(spark, fitted):
    mart = fitted[0]
    params = boosting.BoostingParams(max_trees=4, depth=3)
    got = []
    for partitions in (2, 9):
        dealt = cut_lineage(mart.repartition(partitions))
        scores = boosting.boosted_scores(mart, *boosting.fit_boosted(dealt, params))
        got.append(sorted((r[0], r[1]) for r in scores.collect()))
    assert got[0] == got[1]


def test_more_kinds_of_loan_than_bins(spark, fitted):
    many = cut_lineage(fitted[0].withColumn("contract_type", F.concat(F.lit("kind "), F.col(ID) % 90)))
    encoder, model = boosting.fit_boosted(many, boosting.BoostingParams(max_trees=2, depth=2))
    assert boosting.boosted_scores(many, encoder, model).count() == many.count()
