"""What a model learned, as tables. Their size is that of the model, not of the data."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import FeatureHasher, ImputerModel, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WEIGHTS_SCHEMA = "processed_input string, weight double, category_weights array<struct<category: string, weight: double>>"


def _slots(model: PipelineModel) -> list[tuple[str, str | None]]:
    """(column, category or None) of every place in the feature vector."""
    slots: list[tuple[str, str | None]] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                slots += [(column, label) for label in [*labels, "__unseen"]]
        elif isinstance(stage, FeatureHasher):
            slots += [("hashed", str(i)) for i in range(stage.getNumFeatures())]
        elif isinstance(stage, ImputerModel):
            slots += [(column, None) for column in stage.getInputCols()]
    return slots


def weights_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per input: a number for a numeric column, an array of (category, weight) for a categorical one."""
    final = model.stages[-1]
    rows: dict[str, tuple[float | None, list[tuple[str, float]]]] = {}
    for (column, category), weight in zip(_slots(model), final.coefficients.toArray().tolist()):
        if category is None:
            rows[column] = (weight, [])
        else:
            rows.setdefault(column, (None, []))[1].append((category, weight))
    rows["__INTERCEPT__"] = (float(final.intercept), [])
    return spark.createDataFrame([(c, w, cats) for c, (w, cats) in rows.items()], WEIGHTS_SCHEMA)


def category_weights(weights: DataFrame) -> DataFrame:
    """One row per category."""
    return weights.select("processed_input", F.explode("category_weights").alias("expanded")).select(
        "processed_input", "expanded.category", "expanded.weight"
    )


def importance_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance per input of a tree model, the categories of a column added up."""
    totals: dict[str, float] = {}
    for (column, _), value in zip(_slots(model), model.stages[-1].featureImportances.toArray().tolist()):
        totals[column] = totals.get(column, 0.0) + value
    rows = sorted(totals.items(), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")
