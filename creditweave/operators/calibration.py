"""Isotonic calibration of predicted probabilities.

The fit is the lower convex hull of the running sums of hits over running
counts, in the order of scores: its slopes are the calibrated probabilities.
Hulls are taken per range of scores and merged in a tree. A merge only needs
the corners of the hulls below it, so no task ever holds all points, and
nothing comes to the driver: the model is a table of blocks.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from creditweave.operators.ordering import RANGE, carried, range_number, running_totals
from creditweave.session import cut_lineage
from creditweave.settings import TARGET

# Hulls that one merge joins.
FAN_IN = 32
CORNERS = "_range int, n long, hits long, score double, following double"
BLOCKS = "low double, high double, value double, next_low double, next_value double"


def lower_hull(points: Iterable[tuple]) -> list[tuple]:
    """Corners of the lower convex hull of points ``(n, hits, ...)`` in ascending order of n, in whole numbers."""
    corners: list[tuple] = []
    for p in points:
        while len(corners) > 1:
            (n0, y0), (n1, y1) = corners[-2][:2], corners[-1][:2]
            if (y1 - y0) * (p[0] - n1) < (p[1] - y1) * (n1 - n0):
                break
            corners.pop()
        corners.append(p)
    return corners


def _range_hull(frame: pd.DataFrame) -> pd.DataFrame:
    """The corners of one range's points, each with the score that follows it in the range."""
    frame = frame.sort_values("n")
    points = [(int(n), int(y), s) for n, y, s in zip(frame["n"], frame["hits"], frame["score"])]
    after = dict(zip((p[0] for p in points), [p[2] for p in points[1:]] + [None]))
    # The least score of a range is told by a corner before all of its points.
    first = int(frame["_range"].iloc[0])
    rows = [(first, -1, 0, None, points[0][2])] + [(first, n, y, s, after[n]) for n, y, s in lower_hull(points)]
    return pd.DataFrame(rows, columns=["_range", "n", "hits", "score", "following"]).astype({"score": float, "following": float})


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """One hull of the hulls of neighbouring ranges."""
    frame = frame.sort_values(["_range", "n"])
    points: list[list] = []
    least = None
    for _, n, y, score, following in frame.itertuples(index=False):
        if n < 0:  # where a range begins, the last point before learns what follows it
            if points:
                points[-1][3] = following
            least = following if least is None else least
        else:
            points.append([int(n), int(y), score, following])
    first = int(frame["_range"].min()) // FAN_IN
    rows = [(first, -1, 0, None, least)] + [(first, *p) for p in lower_hull(map(tuple, points))]
    return pd.DataFrame(rows, columns=["_range", "n", "hits", "score", "following"]).astype({"score": float, "following": float})


def _blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """Blocks of equal value between the corners of the whole hull, in order."""
    frame = frame.sort_values("n")
    corners = [(0, 0, None, float(frame["following"].iloc[0]))]
    corners += [(int(n), int(y), s, f) for _, n, y, s, f in frame.iloc[1:].itertuples(index=False)]
    # The origin belongs to the hull: it may cut off corners at the beginning.
    corners = lower_hull(corners)
    rows = [(a[3], b[2], (b[1] - a[1]) / (b[0] - a[0])) for a, b in zip(corners, corners[1:])]
    later = [(r[0], r[2]) for r in rows[1:]] + [(None, None)]
    return pd.DataFrame([(*r, *n) for r, n in zip(rows, later)], columns=["low", "high", "value", "next_low", "next_value"]).astype(float)


def fit_calibrator(fold: DataFrame, score: str = "predicted_pd", target: str = TARGET) -> DataFrame:
    """The monotone map from raw to calibrated probability, as a table of blocks.

    Scores from ``low`` to ``high`` have the block's ``value``; the next
    block's beginning stands beside it. Rows without a score or target, or
    with NaN as a score, take no part; targets are 0 or 1. No rows give no blocks.
    """
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(target).isNotNull()
    counted = fold.where(known).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(target).cast("long")).alias("own")
    )
    points = cut_lineage(running_totals(counted, ["score"], {"n": "rows", "hits": "own"}).select("score", "n", "hits"))
    ranged = points.withColumn(RANGE, range_number(points, ["score"]))
    hulls = ranged.groupBy(RANGE).applyInPandas(_range_hull, CORNERS)
    # Ranges are numbered below a fixed bound, so the tree's height is fixed too.
    ranges = 1024
    while ranges > 1:
        hulls = hulls.groupBy(F.floor(F.col(RANGE) / FAN_IN).cast("int").alias("_group")).applyInPandas(_merged, CORNERS)
        ranges //= FAN_IN
    return cut_lineage(hulls.groupBy(RANGE).applyInPandas(_blocks, BLOCKS))


def calibrate(scores: DataFrame, model: DataFrame, score: str = "predicted_pd", name: str = "calibrated_pd") -> DataFrame:
    """Add the calibrated probability.

    Between blocks it is interpolated, beyond them clipped; missing and NaN
    scores have none. Distinct scores are put in order with the blocks, each
    takes the last block before it, and rows look their score up.
    """
    x = F.col("_x")
    asked = scores.select(F.col(score).cast("double").alias("_x")).where("_x is not null and not isnan(_x)").distinct()
    # The first block also serves the scores below it.
    least = model.agg(F.min("low")).scalar()
    begin = F.when(F.col("low") == least, F.lit(float("-inf"))).otherwise(F.col("low"))
    both = model.select(begin.alias("_x"), F.lit(0).alias("_kind"), F.struct(model.columns).alias("_block")).unionByName(
        asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True
    )
    met = carried(both, ["_x", "_kind"], "_block").where("_kind = 1")
    block = F.col("_block")
    share = (x - block["high"]) / (block["next_low"] - block["high"])
    between = block["value"] + (block["next_value"] - block["value"]) * share
    value = F.when((x > block["high"]) & block["next_low"].isNotNull(), between).otherwise(block["value"])
    found = met.select("_x", value.alias(name))
    return scores.join(found, F.col(score).cast("double") == F.col("_x"), "left").drop("_x")
