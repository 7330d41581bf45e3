"""Small local records as tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 * 1024 * 1024  # of the records in memory, text included


def local_table(spark: SparkSession, records: pd.DataFrame) -> DataFrame:
    """A pandas frame as a table; a named index becomes a column."""
    named = all(name is not None for name in records.index.names)
    return spark.createDataFrame(records.reset_index() if named else records)


def lookup_join(facts: DataFrame, records: pd.DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join local records onto a fact table. Their size in bytes is known here, so only a small list is broadcast."""
    lookup = local_table(facts.sparkSession, records)
    if records.memory_usage(deep=True).sum() <= BROADCAST_BYTES:
        lookup = F.broadcast(lookup)
    return facts.join(lookup, on, how)
