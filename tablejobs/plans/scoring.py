"""Scoring models: repurchase (numeric features) and trip type (categorical features)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.models import metrics, training
from tablejobs.models.category_trees import fit_boosting, fit_forest
from tablejobs.models.features import TripFeatures, trip_columns
from tablejobs.operators import hash_split
from tablejobs.plans.hires import trip_type


def feature_columns(table: DataFrame, *others: str) -> list[str]:
    return [c for c in table.columns if c not in others]


def fit_repurchase(
    table: DataFrame,
    estimator: Estimator,
    eval_fraction: float = 0.75,
    weights: Mapping[object, float] | None = None,
    seed: str = "repurchase",
    extra: Sequence[str] = (),
) -> tuple[PipelineModel, DataFrame]:
    """Model of ``cible`` on the training share, and the whole table with its share marked and scored. ``extra`` columns are
    no features, but kept for the estimator."""
    split = hash_split(table, "user_id", eval_fraction, seed)
    numeric = feature_columns(table, "user_id", "cible", *extra)
    weight = None if weights is None else training.class_weight("cible", weights)
    model = training.fit(split.filter(~F.col("is_eval")), "cible", estimator, numeric=numeric, extra=extra, weight=weight)
    return model, training.score(model, split)


def report(scored: DataFrame, label: str, threshold: float) -> DataFrame:
    """Metrics, confusion matrix and ROC points of scored rows in one long table: (item, at, value).

    ``at`` is null for a metric, "expected/predicted" for a cell of the matrix and the threshold for a point of the curve.
    """
    numbers = metrics.evaluate_classification(scored, label, "score", threshold)
    long = numbers.unpivot([], numbers.columns, "item", "value").select("item", F.lit(None).cast("string").alias("at"), "value")
    cells = metrics.confusion_matrix(scored, label, "score", threshold).unpivot(
        "expected_label", ["predicted_0", "predicted_1"], "predicted", "value"
    )
    place = F.concat_ws("/", F.col("expected_label").cast("string"), F.substring("predicted", -1, 1))
    matrix = cells.select(F.lit("confusion").alias("item"), place.alias("at"), F.col("value").cast("double").alias("value"))
    curve = metrics.roc_curve(scored, label, "score").unpivot("threshold", ["recall", "false_positive_rate"], "name", "value")
    points = curve.select(
        F.concat(F.lit("roc_"), F.col("name")).alias("item"), F.col("threshold").cast("string").alias("at"), "value"
    )
    return long.unionByName(matrix).unionByName(points)


def trip_rows(placed_hires: DataFrame, limit: float) -> DataFrame:
    """Hires with their place and a 0/1 label for long trips."""
    labelled = placed_hires.withColumn("type_trajet", trip_type(limit))
    return labelled.withColumn("is_long", (F.col("type_trajet") == "long").cast("int"))


def fit_trip_type(
    rows: DataFrame,
    estimator: Estimator,
    eval_fraction: float = 0.9,
    version: str = "geo",
    count_rows: bool = False,
    extra: Sequence[str] = (),
    seed: str = "trip",
) -> tuple[PipelineModel, DataFrame]:
    """Classifier of long trips on the training share, and the held-out hires with their score."""
    split = hash_split(rows, "hire_id", eval_fraction, seed)
    model = training.fit(
        split.filter(~F.col("is_eval")),
        "is_long",
        estimator,
        categorical=list(trip_columns(version)),
        prepare=TripFeatures(version),
        extra=extra,
        count_rows=count_rows,
    )
    return model, training.score(model, split.filter("is_eval"))


def _trip_split(rows: DataFrame, eval_fraction: float, version: str, seed: str) -> tuple[DataFrame, DataFrame]:
    split = TripFeatures(version).transform(hash_split(rows, "hire_id", eval_fraction, seed))
    return split.filter(~F.col("is_eval")), split.filter("is_eval")


def forest_trip_type(rows: DataFrame, eval_fraction: float = 0.9, version: str = "geo", seed: str = "trip") -> DataFrame:
    """The held-out hires with the score of a forest, as ``fit_trip_type`` with any number of places."""
    train, held_out = _trip_split(rows, eval_fraction, version, seed)
    return fit_forest(train, "is_long", "hire_id", list(trip_columns(version))).transform(held_out)


def boosted_trip_type(rows: DataFrame, stops: str, eval_fraction: float = 0.9, version: str = "geo", seed: str = "trip") -> DataFrame:
    """The same with boosted trees; rows marked in ``stops`` decide when they end."""
    train, held_out = _trip_split(rows, eval_fraction, version, seed)
    return fit_boosting(train, "is_long", "hire_id", list(trip_columns(version)), stops).transform(held_out)
