"""What the operators share: reading tables, tables written between steps, joins on document ids of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.sources.tables import materialize

# A list of ids is broadcast up to this many rows (16 bytes each in the hash table: 64 MB); beyond it the join shuffles.
BROADCAST_IDS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a table in the folder that ``spark.checkpoint.dir`` names: lineage ends there."""
    return materialize(df, label)


def join_ids(df: DataFrame, ids: DataFrame, column: str, how: str) -> DataFrame:
    """Semi or anti join of whole rows with one column of ids, without moving the rows when the counted ids are few."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, column, how)
