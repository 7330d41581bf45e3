"""Fits. Each returns a PipelineModel that scores raw rows and can be saved with ``.write().save(path)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.models.features import encoding

ROWS_PER_TASK = 50_000


def fit(
    df: DataFrame,
    label: str,
    estimator: Estimator,
    categorical: Sequence[str] = (),
    numeric: Sequence[str] = (),
    prepare: Transformer | None = None,
    extra: Sequence[str] = (),
    weight: Column | None = None,
    count_rows: bool = False,
    hashed: Sequence[str] = (),
) -> PipelineModel:
    """Fit ``estimator`` on the encoded columns, with ``prepare`` as the first stage of the resulting model.

    ``weight`` is computed from the label. ``count_rows`` first groups equal rows and weights them by their number: where all
    features are categories this leaves one row per combination, however many rows there were. It suits losses that are sums
    over rows; a penalty must not be standardised then, because MLlib's deviation of weighted rows is another one. ``extra`` columns are kept for the estimator.
    ``hashed`` names categorical columns with too many values for a list (see ``encoding``).
    """
    prepared = df if prepare is None else prepare.transform(df)
    rows = prepared.select(
        *categorical,
        *[F.col(c).cast("double").alias(c) for c in numeric],
        F.col(label).cast("double").alias(label),
        *extra,
    )
    weights = [] if weight is None else [weight]
    if count_rows:
        rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("__rows"))
        weights.append(F.col("__rows"))
    estimator = estimator.copy()
    if weights:
        rows = rows.withColumn("__weight", reduce(lambda a, b: a * b, weights))
        estimator.setWeightCol("__weight")
    rows = rows.persist()
    try:
        few = rows.coalesce(rows.count() // ROWS_PER_TASK + 1)  # iterations over few rows need few tasks
        fitted = Pipeline(stages=[*encoding(categorical, numeric, hashed), estimator.setLabelCol(label)]).fit(few)
    finally:
        rows.unpersist()
    return PipelineModel(([] if prepare is None else [prepare]) + fitted.stages)


def _elastic(l1: float, l2: float) -> dict[str, float]:
    total = l1 + l2
    return {"regParam": total, "elasticNetParam": l1 / total if total else 0.0}


def linear(l1: float = 0.0, l2: float = 0.0, max_iter: int = 100) -> LinearRegression:
    """Least squares; up to 4,096 encoded features MLlib solves it from one pass over the rows."""
    return LinearRegression(maxIter=max_iter, **_elastic(l1, l2))


def logistic(l1: float = 0.0, l2: float = 0.0, max_iter: int = 100, standardize: bool = True) -> LogisticRegression:
    """With ``standardize=False`` the penalties apply to the weights as they are; grouped rows need that (see ``fit``)."""
    return LogisticRegression(maxIter=max_iter, standardization=standardize, **_elastic(l1, l2))


def boosted_trees(
    max_iter: int = 50,
    learn_rate: float = 0.1,
    subsample: float = 0.5,
    max_depth: int = 5,
    min_rows: int = 50,
    columns_per_node: str = "all",
    validation: str | None = None,
    seed: int = 0,
) -> GBTClassifier:
    """Boosted trees over binned features. ``validation`` names a boolean column whose rows decide when to stop."""
    model = GBTClassifier(
        maxIter=max_iter,
        stepSize=learn_rate,
        subsamplingRate=subsample,
        maxDepth=max_depth,
        minInstancesPerNode=min_rows,
        featureSubsetStrategy=columns_per_node,
        validationTol=0.01,
        seed=seed,
    )
    return model if validation is None else model.setValidationIndicatorCol(validation)


def forest(
    trees: int = 100, subsample: float = 0.67, max_depth: int = 8, min_rows: int = 50, seed: int = 0
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, subsamplingRate=subsample, maxDepth=max_depth, minInstancesPerNode=min_rows, seed=seed
    )


def class_weight(label: str, weights: Mapping[object, float]) -> Column:
    """Weight of each row from its label; a label that is not listed weighs 1."""
    chosen = F
    for value, weight in weights.items():
        chosen = chosen.when(F.col(label) == value, float(weight))
    return chosen.otherwise(1.0)


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Input columns and the share of class 1."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*df.columns, name)


def predict(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Input columns and the prediction."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(name))
