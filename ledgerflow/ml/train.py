"""The three classifiers on ``pyspark.ml`` and scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.ml import boosting, forest
from ledgerflow.ml.features import FEATURES, class_weights
from ledgerflow.settings import scratch_dir

LABEL = "is_fraud"
VECTOR = "features"
# Up to this many rows, the classifier of ``pyspark.ml`` keeps the rows with their draws and nodes, about 900 bytes each.
CLASSIFIER_ROWS = 500_000


def assemble(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Adds the feature vector. Casting drops column metadata, so category codes count as numbers."""
    plain = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return VectorAssembler(inputCols=list(cols), outputCol=VECTOR).transform(plain)


def _fitted(estimator, train: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """The fitted model as it is stored, without the training summary.

    A summary holds the session, and scoring sends the whole model to the tasks: once the session has been used for what
    cannot be sent, such as an observation, a model with its summary cannot score.
    """
    assembler = VectorAssembler(inputCols=list(cols), outputCol=VECTOR)
    model, path = estimator.fit(assembler.transform(train)), scratch_dir(train.sparkSession, "model")
    model.write().overwrite().save(path)
    return PipelineModel([assembler, type(model).load(path)])


def random_forest(
    train: DataFrame, cols: Sequence[str] = FEATURES, trees: int = 100, depth: int = 12, seed: int = 42
) -> PipelineModel:
    """Forest with balanced class weights. Depth is bounded, as the trees are grown level by level on the cluster.

    Beyond ``CLASSIFIER_ROWS`` the trees grow from counts (``ledgerflow.ml.forest``): the same method, other random draws.
    """
    estimator = RandomForestClassifier(
        labelCol=LABEL,
        featuresCol=VECTOR,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=1024,
        # Each row's node in each tree is kept from level to level, so rows do not walk the trees from the root again.
        cacheNodeIds=True,
    )
    per_class = forest.classes(train, LABEL)
    if sum(per_class.values()) > CLASSIFIER_ROWS and {*per_class} == {0.0, 1.0}:
        assembler = VectorAssembler(inputCols=list(cols), outputCol=VECTOR)
        per_node = math.ceil(math.sqrt(len(cols)))
        return PipelineModel([assembler, forest.fit(estimator, train, cols, per_class, per_node)])
    return _fitted(estimator, class_weights(train, LABEL), cols)


def gradient_boosting(
    train: DataFrame, cols: Sequence[str] = FEATURES, rounds: int = 100, depth: int = 3, step: float = 0.1, seed: int = 42
) -> boosting.Boosted:
    """Boosted trees without class weights."""
    return boosting.fit(train, LABEL, cols, rounds, depth, step, seed)


def logistic_regression(train: DataFrame, cols: Sequence[str] = FEATURES, iterations: int = 1000) -> PipelineModel:
    """Ridge-penalised logistic regression with balanced class weights; ``train`` is standardized already.

    A penalty of 1 on the summed loss is 1 / (sum of weights) on Spark's averaged loss. Balanced weights add up to the
    number of rows.
    """
    rows = train.count()
    model = LogisticRegression(
        labelCol=LABEL,
        featuresCol=VECTOR,
        weightCol="weight",
        maxIter=iterations,
        regParam=1.0 / max(rows, 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    return _fitted(model, class_weights(train, LABEL), cols)


def score(model: PipelineModel | boosting.Boosted, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (0/1) and ``probability`` of fraud."""
    if isinstance(model, boosting.Boosted):
        return model.transform(df)
    out = model.transform(df)
    return out.withColumns(
        {"prediction": F.col("prediction").cast("int"), "probability": vector_to_array("probability")[1]}
    ).drop(VECTOR, "rawPrediction")


def feature_importance(model: PipelineModel, names: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, importance, above_median), largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    middle = table.agg(F.median("importance")).scalar()
    return table.withColumn("above_median", F.col("importance") > middle).orderBy(F.desc("importance"), "feature")
