"""Running sums over a whole table, without a window that one task would have to hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.sources import materialize


def _edges(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in order]


def prefix_sums(
    df: DataFrame, order: Sequence[str], sums: Mapping[str, str], by: Sequence[str] = (), descending: bool = False, parts: int | None = None
) -> DataFrame:
    """``df`` with a column for each of ``sums`` (new name: column): its sum over the rows up to and including this one.

    Rows are dealt to ranges of (``by``, ``order``) and written; a range adds up its own rows behind the totals of those before it,
    which are one row for each range and value of ``by``. So a value of ``by`` may hold any share of the rows. ``order`` should
    tell rows apart inside ``by``: equal ones are taken in an order that holds for this result only. Nulls count as 0.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__spread", F.monotonically_increasing_id())  # equal rows may fill several ranges
    edges = [*[F.asc_nulls_first(c) for c in by], *_edges(order, descending), F.asc("__spread")]
    ranged = materialize(keyed.repartitionByRange(parts, *edges).withColumn("__part", F.spark_partition_id()), "ranges")
    keys = {f"__by{i}": F.col(c) for i, c in enumerate(by)}
    totals = ranged.groupBy("__part", *[k.alias(n) for n, k in keys.items()]).agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(sums.values())])
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select(F.col("__part").alias("__range"), *keys, *[F.sum(f"__t{i}").over(before).alias(f"__b{i}") for i in range(len(sums))])
    same = F.col("__part") == F.col("__range")
    for i, c in enumerate(by):
        same &= ranged[c].eqNullSafe(F.col(f"__by{i}"))
    inside = Window.partitionBy("__part", *by).orderBy(*_edges(order, descending), "__spread").rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(totals, same)
    found = [(F.coalesce(F.col(f"__b{i}"), F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for i, (n, c) in enumerate(sums.items())]
    return joined.select(*[ranged[c] for c in df.columns], *found)
