"""Additive attribution of boosted-tree scores to features.

Path-dependent Shapley values (Lundberg et al., 2018/2020) in closed form per
leaf. A leaf with distinct features S gives feature f

    value * (o_f - z_f) * sum over T in S-f of |T|! (|S|-|T|-1)! / |S|!
                          * prod(o in T) * prod(z in rest)

where o says whether the row meets all conditions on a feature along the path
and z is the share of training rows that do. A depth-5 path has at most five
features, so a leaf's contributions are a table over at most 32 bit patterns:
rows only look them up. The model's leaves are a fixed-size table shipped with
the task; the rows stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, types as T

from creditweave.operators.boosting import SLOT_FEATURE, encode
from creditweave.session import scratch_path
from creditweave.settings import FEATURES, ID


@dataclass
class Condition:
    """What a path asks of one slot: an interval or a set of categories."""

    low: float = -np.inf
    high: float = np.inf
    categories: frozenset[int] | None = None
    cover: float = 1.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        if self.categories is not None:
            return np.isin(x, list(self.categories))
        return (x > self.low) & (x <= self.high)


@dataclass
class Leaf:
    slots: list[int]
    conditions: list[Condition]
    table: np.ndarray  # [bit pattern, position in slots]
    expected: float


def shapley_table(value: float, covers: list[float]) -> np.ndarray:
    """Contributions of a leaf for every pattern of met conditions, all patterns at once."""
    size = len(covers)
    met = (np.arange(2**size)[:, None] >> np.arange(size)) & 1
    cover = np.array(covers)
    table = np.empty((2**size, size))
    for i in range(size):
        # Coefficients by how many of the other features are in the set.
        sums = np.zeros((2**size, size))
        sums[:, 0] = 1.0
        for j in range(size):
            if j != i:
                taken = np.concatenate((np.zeros((2**size, 1)), sums[:, :-1]), axis=1)
                sums = sums * cover[j] + taken * met[:, [j]]
        weight = np.array([factorial(n) * factorial(size - n - 1) / factorial(size) for n in range(size)])
        table[:, i] = value * (met[:, i] - cover[i]) * (sums @ weight)
    return table


def tree_leaves(nodes: dict[int, dict], scale: float) -> list[Leaf]:
    """Leaves of one tree; nodes as Spark ML stores them, keyed by node id."""
    found: list[Leaf] = []

    def walk(node_id: int, path: dict[int, Condition]) -> None:
        node = nodes[node_id]
        if node["leftChild"] < 0:
            covers = [c.cover for c in path.values()]
            value = node["prediction"] * scale
            found.append(
                Leaf(list(path), list(path.values()), shapley_table(value, covers), value * float(np.prod(covers)))
            )
            return
        split = node["split"]
        slot, bounds, categories = split["featureIndex"], split["leftCategoriesOrThreshold"], split["numCategories"]
        here = path.get(slot, Condition())
        for side in ("leftChild", "rightChild"):
            child = nodes[node[side]]
            cover = here.cover * child["rawCount"] / node["rawCount"]
            if categories < 0:
                low, high = here.low, here.high
                if side == "leftChild":
                    high = min(high, bounds[0])
                else:
                    low = max(low, bounds[0])
                there = Condition(low, high, None, cover)
            else:
                left = {int(b) for b in bounds}
                mine = left if side == "leftChild" else set(range(categories)) - left
                allowed = mine if here.categories is None else mine & here.categories
                there = Condition(categories=frozenset(allowed), cover=cover)
            walk(node[side], {**path, slot: there})

    walk(0, {})
    return found


def model_leaves(spark: SparkSession, model: GBTClassificationModel) -> list[Leaf]:
    """All leaves of the model, scaled to log-odds.

    Spark's boosted margin is half the log-odds, hence the factor two. What is
    read here is bounded by tree count and depth, not by the data.
    """
    path = scratch_path(spark, "boosted-model")
    model.write().overwrite().save(path)
    trees: dict[int, dict[int, dict]] = {}
    for row in spark.read.parquet(f"{path}/data").toLocalIterator():
        node = row["nodeData"].asDict(recursive=True)
        trees.setdefault(row["treeID"], {})[node["id"]] = node
    weights = model.treeWeights
    return [leaf for tree, nodes in sorted(trees.items()) for leaf in tree_leaves(nodes, 2.0 * weights[tree])]


def contributions(x: np.ndarray, leaves: list[Leaf], slot_feature: list[int], features: int) -> np.ndarray:
    """Contribution of each model feature for each row of ``x``."""
    phi = np.zeros((len(x), features))
    held: dict[tuple, np.ndarray] = {}
    for leaf in leaves:
        pattern = np.zeros(len(x), dtype=np.int64)
        for bit, (slot, condition) in enumerate(zip(leaf.slots, leaf.conditions)):
            asked = (slot, condition.low, condition.high, condition.categories)
            if asked not in held:
                held[asked] = condition.holds(x[:, slot]).astype(np.int64)
            pattern |= held[asked] << bit
        given = leaf.table[pattern]
        for i, slot in enumerate(leaf.slots):
            phi[:, slot_feature[slot]] += given[:, i]
    return phi


def boosted_contributions(mart: DataFrame, encoder: PipelineModel, model: GBTClassificationModel) -> DataFrame:
    """``application_id, predicted_pd, contributions`` for every row of the mart.

    Contributions are in log-odds and add up, with the model's base value, to
    the score's log-odds.
    """
    spark = mart.sparkSession
    leaves = model_leaves(spark, model)
    slot_feature = [FEATURES.index(f) for f in SLOT_FEATURE]
    scored = model.transform(encode(mart, encoder)).select(
        ID,
        vector_to_array("probability")[1].alias("predicted_pd"),
        vector_to_array("features").alias("x"),
    )
    shipped = spark.sparkContext.broadcast(leaves)

    def attribute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy())
                phi = contributions(x, shipped.value, slot_feature, len(FEATURES))
                yield frame[[ID, "predicted_pd"]].assign(contributions=list(phi))

    schema = scored.select(ID, "predicted_pd").schema.add("contributions", T.ArrayType(T.DoubleType()))
    return scored.mapInPandas(attribute, schema)


def base_value(leaves: list[Leaf]) -> float:
    """Expected log-odds over the training rows."""
    return float(sum(leaf.expected for leaf in leaves))
