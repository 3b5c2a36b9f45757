"""A boosted model as a table of nodes, its scores, and what each feature adds.

The table is plain rows, so it can be written, read back, changed by hand and
recomputed by SQL. A row of data goes left where its number is below the
threshold (any number, if that is infinite), or its category listed; missing
values go where the node says. Trees of one leaf, as the base, add the same to
every row.

Contributions are path-dependent Shapley values (Lundberg et al., 2018/2020)
in closed form per leaf: see ``attribution``, whose formula is evaluated here
for the patterns of met conditions that occur, whatever a path's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, types as T

from creditweave.operators.feature_bins import MISSING, MOST_BINS, RARE, Bins
from creditweave.operators.histogram_boosting import Model
from creditweave.settings import CATEGORICAL, FEATURES, ID, NUMERIC_FEATURES

SCHEMA = (
    "tree int, node int, feature string, threshold double, categories array<string>, missing_left boolean, "
    "left int, right int, value double, cover double"
)


def rule(bins: Bins, feature: str, mask: int) -> tuple[float | None, list[str] | None, bool]:
    """Threshold, listed categories and side of missing values of a split whose ``mask`` of bins goes left.

    Rare and unseen categories are never listed; a mask that has them is to be
    turned round before.
    """
    missing = bool(mask >> MISSING & 1)
    if feature == CATEGORICAL:
        return None, sorted(c for c, b in bins.categories.items() if mask >> b & 1), missing
    edges = bins.edges[feature]
    last = mask.bit_length() - 1
    return (float(edges[last]) if last < len(edges) else np.inf), None, missing


def model_table(spark: SparkSession, model: Model) -> DataFrame:
    """``SCHEMA`` rows of a fitted model; ``cover`` counts the rows its trees were grown on."""
    rows = [(0, 0, None, None, None, None, None, None, model.base, 1.0)]
    for t, tree in enumerate(model.trees, 1):
        for i in range(len(tree.value)):
            cover = float(tree.rows[i])
            if not tree.left[i]:
                rows.append((t, i, None, None, None, None, None, None, float(tree.value[i]), cover))
                continue
            feature, mask, sides = FEATURES[tree.feature[i]], int(tree.mask[i]), (int(tree.left[i]), int(tree.right[i]))
            if feature == CATEGORICAL and mask >> RARE & 1:
                mask, sides = ~mask & ((1 << MOST_BINS) - 1), sides[::-1]
            rows.append((t, i, feature, *rule(model.bins, feature, mask), *sides, None, cover))
    return spark.createDataFrame(rows, SCHEMA)


@dataclass(frozen=True)
class Condition:
    """What a path asks of one feature, and the share of training rows that meet it on the way."""

    low: float = -np.inf
    high: float = np.inf
    missing: bool = True
    # Categories that are let in, or (``barred``) kept out; None asks nothing.
    listed: frozenset | None = None
    barred: bool = False
    share: float = 1.0

    def holds(self, column: np.ndarray) -> np.ndarray:
        if column.dtype == object:
            absent = np.array([c is None for c in column], bool)
            inside = np.isin(column.astype(str), list(self.listed or ())) if len(column) else absent
            found = np.ones(len(column), bool) if self.listed is None else inside != self.barred
        else:
            absent = np.isnan(column)
            found = (column >= self.low) & ((column < self.high) | np.isinf(self.high))
        return np.where(absent, self.missing, found)

    def narrowed(self, node: Row, goes_left: bool, share: float) -> Condition:
        missing, share = self.missing and node.missing_left == goes_left, self.share * share
        if node.categories is None:
            low, high = (self.low, min(self.high, node.threshold)) if goes_left else (max(self.low, node.threshold), self.high)
            return Condition(low, high, missing, None, False, share)
        own = frozenset(node.categories)
        if self.listed is None:
            return Condition(missing=missing, listed=own, barred=not goes_left, share=share)
        if self.barred:
            return Condition(missing=missing, listed=own - self.listed if goes_left else self.listed | own, barred=not goes_left, share=share)
        return Condition(missing=missing, listed=self.listed & own if goes_left else self.listed - own, share=share)


@dataclass
class Leaf:
    value: float
    features: list[int]
    conditions: list[Condition]

    def expected(self) -> float:
        return self.value * float(np.prod([c.share for c in self.conditions]))


def shapley(value: float, shares: np.ndarray, met: np.ndarray) -> np.ndarray:
    """A leaf's contributions ``[pattern, feature]`` for patterns of met conditions."""
    size = len(shares)
    out = np.empty(met.shape)
    weight = np.array([factorial(n) * factorial(size - n - 1) / factorial(size) for n in range(size)])
    for i in range(size):
        # Coefficients by how many of the other features are known.
        sums = np.zeros((len(met), size))
        sums[:, 0] = 1.0
        for j in range(size):
            if j != i:
                known = np.zeros_like(sums)
                known[:, 1:] = sums[:, :-1] * met[:, [j]]
                sums = sums * shares[j] + known
        out[:, i] = value * (met[:, i] - shares[i]) * (sums @ weight)
    return out


@dataclass
class TreeTable:
    """The leaves of a table of nodes, bounded by the model's size, as tasks use them."""

    leaves: list[Leaf] = field(default_factory=list)

    @staticmethod
    def of(table: DataFrame) -> TreeTable:
        nodes = {(r.tree, r.node): r for r in table.collect()}
        leaves: list[Leaf] = []
        for tree in sorted({t for t, _ in nodes}):
            open_nodes: list[tuple[int, dict[int, Condition]]] = [(0, {})]
            while open_nodes:
                number, path = open_nodes.pop()
                node = nodes[tree, number]
                if node.feature is None:
                    leaves.append(Leaf(node.value, list(path), list(path.values())))
                    continue
                f = FEATURES.index(node.feature)
                for child, goes_left in ((node.right, False), (node.left, True)):
                    share = nodes[tree, child].cover / node.cover
                    open_nodes.append((child, {**path, f: path.get(f, Condition()).narrowed(node, goes_left, share)}))
        return TreeTable(leaves)

    def base_value(self) -> float:
        """Expected log-odds over the training rows."""
        return float(sum(leaf.expected() for leaf in self.leaves))

    def explain(self, columns: list[np.ndarray], contributions: bool) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and contributions ``[row, feature]`` (zero if not asked for)."""
        n = len(columns[0])
        margin, phi = np.zeros(n), np.zeros((n, len(FEATURES)))
        held: dict[tuple, np.ndarray] = {}
        for leaf in self.leaves:
            met = np.ones((n, len(leaf.features)), bool)
            for k, (f, condition) in enumerate(zip(leaf.features, leaf.conditions)):
                asked = (f, condition.low, condition.high, condition.missing, condition.listed, condition.barred)
                if asked not in held:
                    held[asked] = condition.holds(columns[f])
                met[:, k] = held[asked]
            margin += np.where(met.all(axis=1), leaf.value, 0.0)
            if contributions and leaf.features:
                code = met @ (1 << np.arange(len(leaf.features)))
                _, first, of = np.unique(code, return_index=True, return_inverse=True)
                given = shapley(leaf.value, np.array([c.share for c in leaf.conditions]), met[first].astype(float))
                phi[:, leaf.features] += given[of]
        return margin, phi


def _columns(frame: pd.DataFrame) -> list[np.ndarray]:
    out = []
    for f in FEATURES:
        if f == CATEGORICAL:
            out.append(np.array([c if isinstance(c, str) else None for c in frame[f]], object))
        else:
            out.append(frame[f].to_numpy(np.float64, na_value=np.nan))
    return out


def _explained(mart: DataFrame, table: DataFrame, contributions: bool) -> DataFrame:
    shipped = mart.sparkSession.sparkContext.broadcast(TreeTable.of(table))

    def explain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            margin, phi = shipped.value.explain(_columns(frame), contributions)
            out = frame[[ID]].assign(predicted_pd=1.0 / (1.0 + np.exp(-margin)))
            yield out.assign(contributions=list(phi)) if contributions else out

    numbers = [mart[f].cast("double").alias(f) for f in NUMERIC_FEATURES]
    schema = mart.select(ID).schema.add("predicted_pd", T.DoubleType())
    if contributions:
        schema = schema.add("contributions", T.ArrayType(T.DoubleType()))
    return mart.select(ID, CATEGORICAL, *numbers).mapInPandas(explain, schema)


def tree_scores(mart: DataFrame, table: DataFrame) -> DataFrame:
    """``application_id, predicted_pd`` of every row: one pass, without a shuffle."""
    return _explained(mart, table, False)


def tree_contributions(mart: DataFrame, table: DataFrame) -> DataFrame:
    """``application_id, predicted_pd, contributions`` of every row.

    Contributions are in log-odds, in feature order, and add up with the
    table's base value to the score's log-odds.
    """
    return _explained(mart, table, True)
