"""Split, train, evaluate, calibrate and score as one Spark application."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, functions as F

from creditweave.operators import calibration, histogram_boosting, metrics, tree_table
from creditweave.operators.scorecard import top_drivers
from creditweave.operators.split import holdout_split
from creditweave.session import cut_lineage
from creditweave.settings import CATEGORICAL, ID, TARGET, Policy


@dataclass
class Trained:
    model: histogram_boosting.Model
    trees: DataFrame
    calibrator: DataFrame
    folds: DataFrame
    evaluated: DataFrame
    params: histogram_boosting.Params


def train(mart: DataFrame, policy: Policy = Policy(), params: histogram_boosting.Params = histogram_boosting.Params()) -> Trained:
    """Fit the booster on train rows and the calibrator on half the holdout."""
    folds = cut_lineage(holdout_split(mart, policy.test_share, policy.seed))
    model = histogram_boosting.fit_boosted(folds.where("fold = 'train'").drop("fold"), params)
    trees = cut_lineage(tree_table.model_table(mart.sparkSession, model))
    holdout = folds.where("fold <> 'train'")
    scores = tree_table.tree_scores(holdout, trees)
    scored = cut_lineage(holdout.join(scores, ID))
    calibrator = calibration.fit_calibrator(scored.where("fold = 'calibration'"))
    return Trained(model, trees, calibrator, folds, calibration.calibrate(scored, calibrator), params)


def evaluation(trained: Trained, run_id: str) -> DataFrame:
    """Metric log rows ``(run_id, stage, metric, value)``.

    AUC and KS of the raw score on the whole holdout, calibration figures on
    the evaluation half only.
    """
    holdout = metrics.score_counts(trained.evaluated, "predicted_pd", TARGET)
    measured = trained.evaluated.where("fold = 'evaluation'")
    calibrated = metrics.score_counts(measured, "calibrated_pd", TARGET)
    brier = metrics.brier(measured, TARGET, {"brier_raw": "predicted_pd", "brier_calibrated": "calibrated_pd"})
    spark = trained.folds.sparkSession
    best = spark.createDataFrame([(float(len(trained.model.trees)),)], "best_iteration double")
    knobs = {k: float(v) for k, v in asdict(trained.params).items() if v is not None}
    params = spark.createDataFrame([tuple(knobs.values())], ", ".join(f"{k} double" for k in knobs))
    return (
        long_metrics(metrics.auc(holdout), run_id, "training")
        .unionByName(long_metrics(metrics.ks(holdout), run_id, "training"))
        .unionByName(long_metrics(best, run_id, "training"))
        .unionByName(long_metrics(metrics.auc(calibrated).withColumnRenamed("auc", "auc_eval"), run_id, "calibration"))
        .unionByName(long_metrics(brier, run_id, "calibration"))
        .unionByName(long_metrics(params, run_id, "params"))
    )


def long_metrics(row: DataFrame, run_id: str, stage: str) -> DataFrame:
    """One row of figures to one metric log row per figure."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns]
    return row.select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.inline(F.array(*pairs))
    )


def reliability_table(trained: Trained, bins: int = 10) -> DataFrame:
    measured = trained.evaluated.where("fold = 'evaluation'")
    return metrics.reliability(metrics.score_counts(measured, "calibrated_pd", TARGET), bins)


def fairness_slices(trained: Trained) -> DataFrame:
    measured = trained.evaluated.where("fold = 'evaluation'")
    return metrics.slice_metrics(measured, "calibrated_pd", TARGET, CATEGORICAL)


def predictions(mart: DataFrame, trained: Trained) -> DataFrame:
    """The prediction table: score and three main drivers of every applicant."""
    return top_drivers(tree_table.tree_contributions(mart, trained.trees))
