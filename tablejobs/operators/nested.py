"""Lines nested in their order, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _arrays(lines: DataFrame, on: str, fields: Sequence[str], name: str) -> DataFrame:
    """One sorted array per key: one scan and one shuffle of the lines."""
    return lines.groupBy(on).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def nest_lines(orders: DataFrame, lines: DataFrame, on: str, fields: Sequence[str], name: str = "details") -> DataFrame:
    """Orders with an array of their lines, sorted by ``fields``, as by ``ARRAY_AGG(STRUCT(…))`` over a left join.

    One row per order at any size; an order without lines keeps one element of nulls. Lines are collected before the join, on
    the join's own key. An array is one cell, so jobs that only need the lines should read them as rows.
    """
    none = F.array(F.struct(*[F.lit(None).cast(lines.schema[f].dataType).alias(f) for f in fields]))
    return orders.join(_arrays(lines, on, fields, name), on, "left").withColumn(name, F.coalesce(name, none))


def flatten(df: DataFrame, array_col: str) -> DataFrame:
    """One row per array element, its fields as columns; an empty or null array leaves no row."""
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, F.explode(array_col).alias("__e")).select(*others, "__e.*")


def lines_json(lines: DataFrame, on: str, fields: Sequence[str], name: str, pretty: bool = False) -> DataFrame:
    """The lines of each key as one JSON array ordered by ``fields``."""
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return _arrays(lines, on, fields, "__items").select(on, F.to_json("__items", options).alias(name))
