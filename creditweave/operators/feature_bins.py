"""The feature frame of the booster: every column cut into a few bins.

Bin edges come from a mergeable quantile sketch: a value counts for the lower
bound of its cell, the numbers that share its sign, exponent and leading
``SKETCH_BITS`` bits. Cells are counted map-side and merge by addition, so
the sketch has a bounded number of rows a feature whatever the table's size,
does not depend on the order of rows, and any engine with IEEE doubles gets the
same one. Missing values have a bin of their own; no number stands in for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from creditweave.session import cut_lineage
from creditweave.settings import CATEGORICAL, FEATURES, NUMERIC_FEATURES

# Leading bits of a value, after the first, that the sketch tells apart: less than 1 % of the value.
SKETCH_BITS = 7
# Bins of a feature with the one for missing values; a set of bins is a 64-bit mask.
MOST_BINS = 64
MISSING = 0
# The bin of categories without one of their own.
RARE = MOST_BINS - 1


def cell(value: Column) -> Column:
    """Lower bound of the sketch cell of a number; tiny ones count as zero."""
    x = value.cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    # The logarithm may be off by a rounding next to a power of two.
    power = guess + F.when(F.pow(F.lit(2.0), guess) > size, -1).when(F.pow(F.lit(2.0), guess + 1) <= size, 1).otherwise(0)
    step = F.pow(F.lit(2.0), power - SKETCH_BITS)
    return F.when(size < 1e-300, 0.0).when(size > 1e300, F.signum(x) * 1e300).otherwise(F.floor(x / step).cast("double") * step)


def known(feature: str) -> Column:
    """The number, or null where it is missing or NaN."""
    x = F.col(feature).cast("double")
    return F.when(~F.isnan(x), x)


def sketch(mart: DataFrame) -> DataFrame:
    """``(feature, low, n)``: rows per cell, null cells for missing values; one pass over all columns."""
    cells = [F.struct(F.lit(f).alias("feature"), cell(known(f)).alias("low")) for f in NUMERIC_FEATURES]
    return mart.select(F.inline(F.array(*cells))).groupBy("feature", "low").agg(F.count(F.lit(1)).alias("n"))


def numeric_bins(cells: DataFrame) -> DataFrame:
    """``(feature, bin, low_edge, n_rows)`` from a sketch: bins of about equal numbers of rows.

    A cell belongs to the quantile that the rows before it reach; quantiles
    without a cell of their own drop out. Windows hold one feature's cells.
    """
    upto = Window.partitionBy("feature").orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.where("low is not null").select(
        "feature", "low", "n", (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("feature")).alias("total"),
    )
    quantile = F.floor(F.col("before") * F.lit(MOST_BINS - 1) / F.col("total"))
    found = placed.groupBy("feature", quantile.alias("quantile")).agg(F.min("low").alias("low_edge"), F.sum("n").alias("n_rows"))
    number = F.row_number().over(Window.partitionBy("feature").orderBy("quantile"))
    missing = cells.where("low is null").select("feature", F.lit(MISSING).alias("bin"), F.lit(None).cast("double").alias("low_edge"), F.col("n").alias("n_rows"))
    return found.select("feature", number.alias("bin"), "low_edge", "n_rows").unionByName(missing)


def category_bins(mart: DataFrame) -> DataFrame:
    """``(feature, bin, category, n_rows)``: the most frequent categories, and one bin for all others."""
    counts = cut_lineage(mart.groupBy(F.col(CATEGORICAL).alias("category")).agg(F.count(F.lit(1)).alias("n_rows")))
    top = counts.where("category is not null").orderBy(F.desc("n_rows"), "category").limit(RARE - 1)
    # One task, for fewer rows than there are bins.
    number = F.row_number().over(Window.orderBy(F.desc("n_rows"), "category"))
    named = cut_lineage(top.withColumn("bin", number))
    rest = counts.join(F.broadcast(named.select("category")), "category", "left_anti")
    other = F.when(F.col("category").isNull(), MISSING).otherwise(F.lit(RARE))
    rest = rest.groupBy(other.alias("bin")).agg(F.sum("n_rows").alias("n_rows")).withColumn("category", F.lit(None).cast("string"))
    return named.unionByName(rest).select(F.lit(CATEGORICAL).alias("feature"), "bin", "category", "n_rows")


def feature_bins(mart: DataFrame) -> DataFrame:
    """``(feature, bin, low_edge, category, n_rows)`` of all features.

    Bin 0 holds missing values and is listed where there are any. A number
    belongs to the last bin whose edge it reaches, or to the first.
    """
    numeric = numeric_bins(cut_lineage(sketch(mart)))
    return numeric.unionByName(category_bins(mart), allowMissingColumns=True).select("feature", "bin", "low_edge", "category", "n_rows")


@dataclass(frozen=True)
class Bins:
    """Edges of the numeric features and places of the categories: at most ``MOST_BINS`` entries a feature."""

    edges: dict[str, np.ndarray]
    categories: dict[str, int]

    @staticmethod
    def of(mart: DataFrame) -> Bins:
        rows = feature_bins(mart).where("bin > 0").collect()
        edges = {f: sorted(r.low_edge for r in rows if r.feature == f) for f in NUMERIC_FEATURES}
        named = {r.category: r.bin for r in rows if r.feature == CATEGORICAL and r.category is not None}
        return Bins({f: np.array(e) for f, e in edges.items()}, named)

    def number(self, frame: pd.DataFrame) -> np.ndarray:
        """Bin of every feature of every row; unseen categories share the bin of the rare ones."""
        out = np.zeros((len(frame), len(FEATURES)), np.uint8)
        for j, f in enumerate(FEATURES):
            if f == CATEGORICAL:
                place = frame[f].map(lambda c: self.categories.get(c, RARE) if isinstance(c, str) else MISSING)
                out[:, j] = place.to_numpy(np.uint8) if len(frame) else 0
            else:
                x = frame[f].to_numpy(np.float64, na_value=np.nan)
                bins = np.maximum(np.searchsorted(self.edges[f], x, side="right"), 1)
                out[:, j] = np.where(np.isnan(x), MISSING, bins)
        return out


# Rows of a block at most.
BLOCK_ROWS = 16_384


def blocks(rows: DataFrame, bins: Bins, carried: list[str]) -> DataFrame:
    """``(rows, x, *carried)``: the bins of some thousand rows at a time as bytes, with other columns as packed doubles."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[start : start + BLOCK_ROWS]
                packed = {c: [part[c].to_numpy(np.int64).tobytes()] for c in carried}
                yield pd.DataFrame({"rows": [len(part)], "x": [bins.number(part).tobytes()], **packed})

    schema = ", ".join(["rows long", "x binary", *[f"{c} binary" for c in carried]])
    return rows.select(*FEATURES, *carried).mapInPandas(pack, schema)
