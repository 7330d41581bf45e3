"""Evaluation tables from labels and predictions that are already columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.operators import exact_quantiles, prefix_sums


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each label value."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def _computed(result: DataFrame, kept: DataFrame) -> DataFrame:
    """A one-row result as data, so that what it was computed from can be released."""
    try:
        return result.sparkSession.createDataFrame([result.first()], result.schema)
    finally:
        kept.unpersist()


def evaluate_regression(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mean and median absolute error, mean squared error and R², over the rows with label and prediction.

    Computed at once, over two kept columns, so that the predictions are made only once.
    """
    error = F.col(label) - F.col(prediction)
    rows = df.select(F.col(label).alias("y"), error.alias("e")).filter("e is not null").withColumn("a", F.abs("e")).persist()
    sums = rows.agg(
        F.avg("a").alias("mean_absolute_error"),
        F.avg(F.col("e") * F.col("e")).alias("mean_squared_error"),
        F.var_pop("y").alias("v"),
    )
    median = exact_quantiles(rows, [], "a", [0.5], ["m"]).scalar()
    return _computed(
        sums.select(
            "mean_absolute_error",
            median.alias("median_absolute_error"),
            "mean_squared_error",
            (1 - F.try_divide("mean_squared_error", "v")).alias("r2_score"),
        ),
        rows,
    )


def _decided(score: str, threshold: float) -> Column:
    return (F.col(score) >= threshold).cast("int")


def evaluate_classification(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: precision, recall, accuracy, F1, log loss and area under the ROC curve. ``score`` is the share of class 1.

    The area is exact: with ``numBins=0`` MLlib sorts the distinct scores over all tasks instead of binning them. Computed at
    once, over two kept columns, so that the scores are made only once.
    """
    rows = df.select(F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("p")).persist()
    area = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(rows)
    yes, said = F.col("y") == 1, F.col("p") >= threshold
    safe = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    sums = rows.agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        F.avg(-F.log(F.when(yes, safe).otherwise(1 - safe))).alias("log_loss"),
    )
    tp, fp, fn, n = F.col("tp"), F.col("fp"), F.col("fn"), F.col("n")
    result = sums.select(
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(n - fp - fn, n).alias("accuracy"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "log_loss",
        F.lit(area).alias("roc_auc"),
    )
    return _computed(result, rows)


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Rows per expected label, one count per predicted label."""
    pairs = df.select(F.col(label).cast("int").alias("expected_label"), _decided(score, threshold).alias("p"))
    return pairs.groupBy("expected_label").agg(
        F.count_if(F.col("p") == 0).alias("predicted_0"), F.count_if(F.col("p") == 1).alias("predicted_1")
    )


def roc_curve(df: DataFrame, label: str, score: str, bins: int | None = 100) -> DataFrame:
    """One row per threshold k / ``bins`` at which some score falls: recall, false positive rate and the four counts. With
    ``bins=None`` every score is a threshold. Rows without score are left out.

    Scores are counted before anything is ordered. Up to ``bins`` + 1 rows meet in a window; distinct scores, which may be as
    many as the rows, are added up over ranges (``prefix_sums``).
    """
    at = F.col(score).cast("double") if bins is None else F.floor(F.col(score) * bins)
    binned = df.select(F.col(label).cast("int").alias("y"), at.alias("bin")).filter("bin is not null")
    counts = binned.groupBy("bin").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    if bins is None:
        summed = prefix_sums(counts, ["bin"], {"true_positives": "p", "false_positives": "n"}, descending=True)
        total = summed.agg(F.struct(F.sum("p").alias("pos"), F.sum("n").alias("neg")).alias("t")).scalar()
        counted = summed.select(F.col("bin").alias("threshold"), "true_positives", "false_positives", total["pos"].alias("pos"), total["neg"].alias("neg"))
    else:
        down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy()
        counted = counts.select(
            (F.col("bin") / bins).alias("threshold"),
            F.sum("p").over(down).alias("true_positives"),
            F.sum("n").over(down).alias("false_positives"),
            F.sum("p").over(whole).alias("pos"),
            F.sum("n").over(whole).alias("neg"),
        )
    return counted.select(
        "threshold",
        F.try_divide("true_positives", "pos").alias("recall"),
        F.try_divide("false_positives", "neg").alias("false_positive_rate"),
        "true_positives",
        "false_positives",
        (F.col("neg") - F.col("false_positives")).alias("true_negatives"),
        (F.col("pos") - F.col("true_positives")).alias("false_negatives"),
    )


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as z-scores (sample deviation; 0 where a column is constant). One aggregate, read as a scalar subquery."""
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns]).alias("v")
    ).scalar()

    def z(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c) - stats[c]["m"], stats[c]["s"]), F.when(F.col(c).isNotNull(), 0.0))

    return df.select(*[z(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def assign_clusters(df: DataFrame, features: Sequence[str], centroids: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest centroid per row, numbered from 1 (the first of equals), and its Euclidean distance; centroids are literals."""
    distances = [
        F.struct(
            sum(((F.col(f) - float(x)) * (F.col(f) - float(x)) for f, x in zip(features, point)), F.lit(0.0)).alias("d"),
            F.lit(i + 1).alias("id"),
        )
        for i, point in enumerate(centroids)
    ]
    nearest = F.array_min(F.array(*distances))
    placed = df.withColumn("__near", nearest)
    return placed.select(*df.columns, F.col("__near.id").alias("centroid_id"), F.sqrt("__near.d").alias("distance"))


def davies_bouldin(assigned: DataFrame, centroids: Sequence[Sequence[float]]) -> DataFrame:
    """One row: Davies-Bouldin index and mean squared distance of rows that carry ``centroid_id`` and ``distance``.

    The k mean distances are the only data gathered; the distances between centroids are known beforehand. A centroid
    without rows is left out.
    """
    k = len(centroids)
    sums = assigned.agg(
        *[F.avg(F.when(F.col("centroid_id") == i + 1, F.col("distance"))).alias(f"s{i}") for i in range(k)],
        F.avg(F.col("distance") * F.col("distance")).alias("mean_squared_distance"),
    )

    def gap(i: int, j: int) -> float:
        return sum((a - b) ** 2 for a, b in zip(centroids[i], centroids[j])) ** 0.5

    def worst(i: int) -> Column:
        ratios = [F.try_divide(F.col(f"s{i}") + F.col(f"s{j}"), F.lit(gap(i, j))) for j in range(k) if j != i]
        return F.array_max(F.array(*ratios))

    rows = F.array_compact(F.array(*[worst(i) for i in range(k)]))
    total = F.aggregate(rows, F.lit(0.0), lambda a, b: a + b)
    return sums.select((total / F.size(rows)).alias("davies_bouldin_index"), "mean_squared_distance")


def segment_profile(assigned: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of each feature per cluster."""
    return assigned.groupBy("centroid_id").agg(*[F.avg(f).alias(f) for f in features])
