"""Join shapes. No side is hinted: adaptive execution broadcasts by measured size and splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_in(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """``WHERE on IN (SELECT on FROM other)``. The distinct collapses repeated keys before they are shuffled."""
    return df.join(other.select(on).distinct(), on, "left_semi")


def anti_in(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; a null key is kept, as by an outer join filtered on null."""
    return df.join(other.select(on).distinct(), on, "left_anti")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where null equals null, keeping one copy of the keys."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"__{k}" for k in keys])


def star_except(df: DataFrame, *columns: str) -> DataFrame:
    """``* EXCEPT(columns)``; naming a column that does not exist is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return df.drop(*columns)


def star_join(base: DataFrame, others: Sequence[DataFrame], on: str) -> DataFrame:
    """``a.*, b.* EXCEPT(key), c.* EXCEPT(key) …`` over left joins on one key."""
    return reduce(lambda left, right: left.join(right, on, "left"), others, base)


def lookup_constants(
    df: DataFrame, lookup: DataFrame, key: str, value: str, names: dict[str, str]
) -> DataFrame:
    """One column per entry of ``names`` (output column -> lookup key), each the constant the lookup holds for that key.

    The lookup is first cut to the keys asked for, folded into one map and read as a scalar subquery, so ``df`` is only
    projected. A key the lookup does not have gives null.
    """
    wanted = lookup.filter(F.col(key).isin(list(names.values()))).groupBy(key).agg(F.max(value).alias("v"))
    constants = wanted.agg(F.map_from_entries(F.collect_list(F.struct(key, "v"))).alias("m")).scalar()
    return df.select("*", *[F.try_element_at(constants, F.lit(k)).alias(out) for out, k in names.items()])


def sum_after_last(df: DataFrame, key: str, order: str, event: Column, value: str, name: str) -> DataFrame:
    """Per key, the sum of ``value`` over the rows after the key's last row where ``event`` holds.

    Keys without such later rows are absent. The last position comes from a plain aggregate, so a hot key needs no window.
    """
    last = df.filter(event).groupBy(key).agg(F.max(order).alias("__last"))
    later = df.select(key, order, value).join(last, key).filter(F.col(order) > F.col("__last"))
    return later.groupBy(key).agg(F.sum(value).alias(name))
