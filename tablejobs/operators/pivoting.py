"""Rows to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def pivot_agg(
    df: DataFrame,
    row_ids: Sequence[str],
    pivot_col: str,
    value_col: str,
    agg: str = "sum",
    max_columns: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One output column per value of ``pivot_col``, in order of value; an empty cell is null.

    More values than ``max_columns`` (None: any number) is an error, never a silent cut. Null pivot values make no column.
    """
    values = df.select(pivot_col).filter(F.col(pivot_col).isNotNull()).distinct()
    found = (values if max_columns is None else values.limit(max_columns + 1)).collect()  # one per column of the result
    if max_columns is not None and len(found) > max_columns:
        raise ValueError(f"{pivot_col} has more than {max_columns} values")
    values = sorted(row[0] for row in found)
    wide = df.groupBy(*row_ids).pivot(pivot_col, values).agg(AGGREGATES[agg.lower()](value_col))
    return wide if limit is None else wide.orderBy(*row_ids).limit(limit)


def unpivot(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str = "measure", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(measures), name, value)
