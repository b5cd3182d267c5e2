"""Training, tuning, storing and applying the models, with Spark ML."""

from __future__ import annotations

import datetime
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline import schemas
from firnline.functions import measure
from firnline.operators import split
from firnline.operators.grid import nested_search
from firnline.operators.profile import balanced_weights
from firnline.session import stage

LABEL, SIZE = "avalanche_occurred", "avalanche_size"
# Spark's deepest tree; stands for "no limit".
DEEPEST = 30


def prepare(training: DataFrame, targets: tuple[str, ...] = (LABEL, SIZE)) -> DataFrame:
    """Rows with all features, and all of ``targets`` if any are named."""
    return training.dropna(subset=[*fv.FEATURES, *targets])


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=fv.FEATURES, outputCol="features")


def forest(**settings) -> RandomForestClassifier:
    """Every node considers the square root of the features; a leaf minimum of 10 makes a split
    minimum of 20 redundant."""
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol="features", seed=fv.SEED, **{**fv.FOREST, **settings}
    )


def train_classifier(train: DataFrame, **settings) -> PipelineModel:
    # The copy leaves the training summary behind, which would travel with every task that scores.
    return Pipeline(stages=[_assembler(), forest(**settings)]).fit(train).copy()


def train_size_regressor(
    training: DataFrame, key: str, **settings
) -> tuple[PipelineModel, DataFrame] | None:
    """Boosted trees on events only; none when there are too few.

    Returns the model and the held-out rows.
    """
    events = split.plain(training.filter(F.col(SIZE) > 0), key)
    if events.limit(fv.MIN_SIZE_EXAMPLES).count() < fv.MIN_SIZE_EXAMPLES:
        return None
    booster = GBTRegressor(
        labelCol=SIZE, featuresCol="features", seed=fv.SEED, **{**fv.BOOSTING, **settings}
    )
    fitted = Pipeline(stages=[_assembler(), booster]).fit(events.filter(~F.col("is_test")))
    return fitted, events.filter("is_test")


def grid_settings(grid: dict = fv.GRID) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def search(train: DataFrame, key: str, grid: dict = fv.GRID, folds: int = fv.FOLDS) -> tuple[DataFrame, DataFrame]:
    """The stored rows with their folds, and one row per setting: mean recall and precision over the folds, and how many
    held-out rows it was scored on. Trees grow on all rows of the other folds.

    Depth ``None`` becomes Spark's deepest tree. Weights per bootstrap sample have no counterpart, and a split minimum
    above twice the leaf minimum neither, so those two axes are not searched.
    """
    weighted = balanced_weights(split.folds(train, LABEL, key, folds), LABEL).withColumn(
        "even", F.lit(1.0)
    )
    rows = stage(weighted, "folds")
    return rows, stage(nested_search(rows, grid, folds, LABEL), "grid")


def tune(
    train: DataFrame, key: str, grid: dict = fv.GRID, folds: int = fv.FOLDS
) -> tuple[PipelineModel, DataFrame]:
    """``search`` for the best recall of events, then a fit on all rows: the model and the row of every setting.

    Of equal recalls the higher precision wins, then the smaller forest.
    """
    rows, results = search(train, key, grid, folds)
    best = results.orderBy(
        F.desc_nulls_last("recall"), F.desc_nulls_last("precision"), "trees", F.asc_nulls_last("depth"),
        F.desc("min_leaf"), "balanced",
    ).first()
    chosen = forest(
        numTrees=best["trees"], maxDepth=best["depth"] or DEEPEST, minInstancesPerNode=best["min_leaf"],
        weightCol="weight" if best["balanced"] else "even",
    ).fit(_assembler().transform(rows))
    return PipelineModel(stages=[_assembler(), chosen.copy()]), results


def importance(model: PipelineModel) -> DataFrame:
    """Feature and importance, most important first; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.active()
    return spark.createDataFrame(
        list(zip(fv.FEATURES, weights)), "feature string, importance double"
    ).orderBy(F.desc("importance"))


def score(model: PipelineModel, rows: DataFrame, threshold: float | Column | None = None):
    """Add ``score``, the probability of an event, and ``danger``.

    With a threshold danger is score >= threshold; without, the larger class wins and a tie is
    safe.
    """
    scored = model.transform(rows).withColumn(
        "score", vector_to_array("probability")[1]
    ).drop("features", "rawPrediction", "probability", "prediction")
    flag = F.col("score") > 0.5 if threshold is None else F.col("score") >= threshold
    return scored.withColumn("danger", flag)


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.SCENARIOS, schemas.SCENARIOS)


def score_scenarios(model: PipelineModel, threshold: float) -> DataFrame:
    rows = score(model, scenarios(SparkSession.active()), threshold)
    return rows.select(
        "name", "score",
        F.when(F.col("danger"), "DANGER").otherwise("SAFE").alias("prediction"),
        measure.risk_level(F.col("score"), F.lit(threshold), levels=2).alias("risk"),
    )


def save(
    model: PipelineModel, path: str, threshold: float, tuned: bool = True,
    model_type: str = "RandomForestClassifier",
) -> None:
    """Write the model and its one-row description."""
    model.write().overwrite().save(f"{path}/model")
    row = (threshold, list(fv.FEATURES), datetime.datetime.now(), model_type, tuned)
    SparkSession.active().createDataFrame([row], schemas.MODEL_META).write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")


def load(path: str) -> tuple[PipelineModel, DataFrame]:
    """The model and its description."""
    spark = SparkSession.active()
    meta = spark.read.schema(schemas.MODEL_META).parquet(f"{path}/meta")
    return PipelineModel.load(f"{path}/model"), meta
