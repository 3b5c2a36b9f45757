"""Gradient-boosted default model on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from creditweave.operators.split import select_share
from creditweave.session import checkpoint_dir, cut_lineage
from creditweave.settings import CATEGORICAL, ID, NUMERIC_FEATURES, TARGET

# What stands in for a missing number; its indicator tells it from a real one.
FILL = -1.0
CATEGORY_INDEX = f"{CATEGORICAL}_index"
VECTOR = [CATEGORY_INDEX, *NUMERIC_FEATURES, *[f"{f}_missing" for f in NUMERIC_FEATURES]]
# The model feature that each vector slot reports to: an indicator's
# contribution belongs to the feature whose absence it marks.
SLOT_FEATURE = [CATEGORICAL, *NUMERIC_FEATURES, *NUMERIC_FEATURES]


@dataclass(frozen=True)
class BoostingParams:
    """Tree count, learning rate, row and column shares, patience.

    A tree of depth 5 has about the 31 leaves asked for.
    """

    max_trees: int = 500
    learning_rate: float = 0.05
    depth: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 50
    seed: int = 42
    # The rows of the fit lie in so many partitions, dealt by id: rows and trees
    # are drawn by partition, and must not depend on the cluster's size.
    partitions: int = 4
    # Labelled rows the fit uses at most, those of least hash. Scores are given to all rows.
    fit_rows: int = 50_000


def numeric_frame(mart: DataFrame) -> DataFrame:
    """Missing numbers filled, with an indicator column for each feature."""
    columns = [F.coalesce(F.col(f).cast("double"), F.lit(FILL)).alias(f) for f in NUMERIC_FEATURES]
    missing = [F.col(f).isNull().cast("double").alias(f"{f}_missing") for f in NUMERIC_FEATURES]
    passed = [c for c in mart.columns if c not in NUMERIC_FEATURES]
    return mart.select(*passed, *columns, *missing)


def fit_encoder(train: DataFrame) -> PipelineModel:
    """Category index and feature vector; categories unseen in training share a slot."""
    indexer = StringIndexer(
        inputCol=CATEGORICAL,
        outputCol=CATEGORY_INDEX,
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    assembler = VectorAssembler(inputCols=VECTOR, outputCol="features")
    return Pipeline(stages=[indexer, assembler]).fit(numeric_frame(train))


def encode(mart: DataFrame, encoder: PipelineModel) -> DataFrame:
    return encoder.transform(numeric_frame(mart))


def best_iteration(losses: list[float], patience: int) -> int:
    """Trees to keep: the best count seen before ``patience`` trees without gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_boosted(train: DataFrame, params: BoostingParams = BoostingParams()) -> tuple[PipelineModel, GBTClassificationModel]:
    """Fit on ``train`` rows; a tenth of them is set aside to stop early.

    The rows that decide when to stop are neither trained on nor used later to
    calibrate or to evaluate. They are judged by log-loss, which Spark reports
    for every number of trees in one pass.
    """
    checkpoint_dir(train.sparkSession)
    train = cut_lineage(train)
    rows = train.count()
    if rows > params.fit_rows:
        train = cut_lineage(select_share(train, params.fit_rows / rows, f"fit-{params.seed}", "_fit").where("_fit").drop("_fit"))
    marked = cut_lineage(select_share(train, 0.1, f"early-stop-{params.seed}", "watched"))
    encoder = fit_encoder(marked)
    # Boosting passes over the rows once per tree level: keep the vectors only.
    rows = encode(marked, encoder).select(ID, "features", F.col(TARGET).cast("double").alias("label"), "watched")
    watched = rows.where("watched")
    fitted = rows.where("not watched").drop("watched").repartition(params.partitions, ID).sortWithinPartitions(ID).persist()
    # Every category, and the slot of unseen ones, needs a bin.
    categories = len(encoder.stages[0].labels) + 1
    booster = GBTClassifier(
        stepSize=params.learning_rate,
        maxDepth=params.depth,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        maxBins=max(32, categories),
        checkpointInterval=20,
        seed=params.seed,
    )
    # Trees are drawn from one seed in order: a model of more trees begins with
    # those of a smaller one. So the count grows until patience is over.
    trees = min(params.max_trees, 2 * params.patience)
    try:
        while True:
            model = booster.fit(fitted, {booster.maxIter: trees})
            keep = best_iteration(list(model.evaluateEachIteration(watched)), params.patience)
            if trees == params.max_trees or keep + params.patience <= trees:
                break
            trees = min(params.max_trees, 2 * trees)
        if keep < trees:
            model = booster.fit(fitted, {booster.maxIter: keep})
    finally:
        fitted.unpersist()
    return encoder, model


def boosted_scores(mart: DataFrame, encoder: PipelineModel, model: GBTClassificationModel) -> DataFrame:
    """Score every row of the mart, training rows included."""
    scored = model.transform(encode(mart, encoder))
    return scored.select(ID, vector_to_array("probability")[1].alias("predicted_pd"))
