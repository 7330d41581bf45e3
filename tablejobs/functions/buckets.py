from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(value: Column | str, splits: Sequence[float]) -> Column:
    """Number of split points at or below the value: 0 before the first; a value on a split opens the next bucket."""
    value = F.col(value) if isinstance(value, str) else value
    cases = F
    for i, split in enumerate(sorted(splits)):
        cases = cases.when(value < split, i)
    return F.when(value.isNotNull(), cases.otherwise(len(splits)))


def feature_cross(*columns: Column | str) -> Column:
    """Several categorical columns as one; null if any of them is."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    spaced = [x for c in columns for x in (F.lit("_"), c.cast("string"))][1:]
    return F.concat(*spaced)
