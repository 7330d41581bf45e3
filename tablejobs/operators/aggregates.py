"""Grouped counts that would otherwise copy every row once per expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cond_count_distinct(
    df: DataFrame, keys: Sequence[str], distinct: str, category: str, groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Many ``COUNT(DISTINCT CASE WHEN category IN (…) THEN distinct END)`` per key; ``groups`` maps output column to categories.

    The category is replaced by its output column, or by one row for each of them where columns share it, and the rows are made
    distinct once; what is left is a plain count.
    """
    names: dict[str, list[str]] = {}
    for name, values in groups.items():
        for v in dict.fromkeys(values):
            names.setdefault(v, []).append(name)
    if any(len(own) > 1 for own in names.values()):
        entries = [x for v, own in names.items() for x in (F.lit(v), F.array(*[F.lit(n) for n in own]))]
        label = F.explode_outer(F.try_element_at(F.create_map(*entries), F.col(category))).alias("__group")
    else:
        entries = [F.lit(x) for v, own in names.items() for x in (v, own[0])]
        label = F.try_element_at(F.create_map(*entries), F.col(category)).alias("__group")
    once = df.select(*keys, distinct, label).distinct()
    return once.groupBy(*keys).agg(
        *[F.count(F.when(F.col("__group") == name, F.col(distinct))).alias(name) for name in groups]
    )


def flag_by_category(
    df: DataFrame, keys: Sequence[str], category: str, names: Mapping[str, str]
) -> DataFrame:
    """Many ``MAX(CASE WHEN category = v THEN 1 ELSE 0 END)`` per key; ``names`` maps output column to category."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(category) == v, 1).otherwise(0)).alias(name) for name, v in names.items()]
    )


def two_level_mean(
    df: DataFrame, outer: Sequence[str], inner: Sequence[str], distinct: Mapping[str, str]
) -> DataFrame:
    """Distinct counts per (outer, inner), then their mean per outer; ``distinct`` maps output column to counted column."""
    keys = [*outer, *inner]
    counted = df.groupBy(*keys).agg(*[F.countDistinct(c).alias(name) for name, c in distinct.items()])
    return counted.groupBy(*outer).agg(*[F.avg(name).alias(name) for name in distinct])
