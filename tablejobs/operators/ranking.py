"""Top rows per group and shares of a group total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.operators.joins import join_null_safe


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    k: int,
    ties: str = "rank",
    tie_break: Sequence[str] = (),
    name: str = "rk",
) -> DataFrame:
    """Rows among the ``k`` highest ``order`` of their group.

    ``ties="row_number"`` keeps exactly k rows and each task passes on at most k rows of a group. ``ties="rank"`` keeps all
    rows that share a kept rank, so the tied rows may be many: only the k best distinct values of each group are ranked, from
    counts, and the rows are then joined to them; no task ever orders a whole group.
    """
    best_first = Window.partitionBy(*by).orderBy(F.desc_nulls_last(order))
    if ties == "row_number":
        numbered = Window.partitionBy(*by).orderBy(F.desc_nulls_last(order), *tie_break)
        return df.withColumn(name, F.row_number().over(numbered)).filter(F.col(name) <= k)
    if ties != "rank":
        raise ValueError("ties must be 'rank' or 'row_number'")
    values = df.groupBy(*by, order).agg(F.count(F.lit(1)).alias("__rows"))
    best = values.withColumn("__nth", F.row_number().over(best_first)).filter(F.col("__nth") <= k)
    better = F.sum("__rows").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    ranks = best.select(*by, order, (F.coalesce(better, F.lit(0)) + 1).alias(name)).filter(F.col(name) <= k)
    return join_null_safe(df, ranks, [*by, order])


def top_names(df: DataFrame, name: str, k: int) -> DataFrame:
    """The k most frequent values of a column, ties by value: (name, n)."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(name)).limit(k)


def partition_sum(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY by)``, from partial sums joined back, so a hot group is never gathered."""
    totals = df.groupBy(*by).agg(F.sum(value).alias(name))
    return join_null_safe(df, totals, by, "left")


def ratio_to_subtotal(
    df: DataFrame, by: Sequence[str], value: str, subtotal: str, ratio: str, scale: int = 100
) -> DataFrame:
    """Share of each row in its group total, rounded half up to whole ``1/scale``."""
    summed = partition_sum(df, by, value, subtotal)
    return summed.withColumn(ratio, F.round(F.col(value) / F.col(subtotal) * scale))
