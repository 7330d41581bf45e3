"""Interpolated quantiles and the classes cut from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.operators.joins import join_null_safe
from tablejobs.operators.pivoting import unpivot

QUARTILES = (0.25, 0.5, 0.75)


def _interpolate(counts: DataFrame, keys: Sequence[str], value: str, position: Column, name: str) -> DataFrame:
    """Value at a fractional 0-based rank per group of a (keys, value, __rows) table; ``position`` is constant in a group."""
    upwards = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(value)).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("__upto", F.sum("__rows").over(upwards)).withColumn("__pos", position)

    def at(rank: Column) -> Column:
        here = (F.col("__upto") - F.col("__rows") <= rank) & (rank < F.col("__upto"))
        return F.max(F.when(here, F.col(value)))

    ends = placed.groupBy(*keys).agg(
        at(F.floor("__pos")).alias("__lo"), at(F.ceil("__pos")).alias("__hi"), F.max("__pos").alias("__pos")
    )
    part = F.col("__pos") - F.floor("__pos")
    return ends.select(*keys, (F.col("__lo") * (1 - part) + F.col("__hi") * part).alias(name))


def _wide(long: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)])


def quartiles(
    wide: DataFrame,
    measures: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    name: str = "measure",
) -> DataFrame:
    """Cut points of integer count columns, one row per measure: (measure, cut_1, cut_2, …).

    One pass: the columns become rows and equal values are counted before anything is ordered. Only the distinct values of a
    measure meet in a window; counts that add up to N rows have at most about sqrt(2 N) of them. For columns with many
    distinct values use ``exact_quantiles``.
    """
    long = unpivot(wide, [], measures, name).filter(F.col("value").isNotNull())
    counts = long.groupBy(name, "value").agg(F.count(F.lit(1)).alias("__rows"))
    total = F.sum("__rows").over(Window.partitionBy(name))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(float(p)).alias("__p")) for i, p in enumerate(probs)]))
    spread = counts.withColumn("__n", total).withColumn("__c", each).select("*", "__c.*")
    found = _interpolate(spread, [name, "__i"], "value", F.col("__p") * (F.col("__n") - 1), "__q")
    return _wide(found, [name], [f"cut_{i + 1}" for i in range(len(probs))])


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    accuracy: int = 100_000,
) -> DataFrame:
    """Exact interpolated quantiles of a column with any number of distinct values, one row per group.

    A first pass brackets each quantile with ``percentile_approx``, whose rank error is at most ``1/accuracy``. A second pass
    counts the rows below the bracket and orders only the distinct values inside it: about ``6/accuracy`` of a group, however
    large it is. Groups of up to ``accuracy`` rows are taken whole.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    margin = 3 / accuracy
    around = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    bounds = rows.groupBy(*by).agg(
        F.percentile_approx("__v", around, accuracy).alias("q"), F.count(F.lit(1)).alias("n")
    )
    low, high = F.slice("q", 1, len(probs)).alias("lo"), F.slice("q", len(probs) + 1, len(probs)).alias("hi")
    packed = bounds.select(*by, F.struct(low, high, "n").alias("__b"))
    bounded = join_null_safe(rows, packed, list(by)) if by else rows.withColumn("__b", packed.scalar())

    def place(i: int, p: float) -> Column:
        inside = (F.col("__b.n") <= accuracy) | F.col("__v").between(F.col("__b.lo")[i], F.col("__b.hi")[i])
        spot = F.struct(
            F.lit(i).alias("__i"),
            F.when(inside, F.col("__v")).alias("__v"),
            (F.lit(float(p)) * (F.col("__b.n") - 1)).alias("__p"),
        )
        return F.when(inside | (F.col("__v") < F.col("__b.lo")[i]), spot)

    spots = F.explode(F.array_compact(F.array(*[place(i, p) for i, p in enumerate(probs)])))
    counts = bounded.select(*by, spots.alias("__c")).groupBy(*by, "__c.__i", "__c.__p", "__c.__v")
    counted = counts.agg(F.count(F.lit(1)).alias("__rows"))
    found = _interpolate(counted, [*by, "__i"], "__v", F.col("__p"), "__q")
    checked = F.coalesce("__q", F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    return _wide(found.withColumn("__q", checked), by, names)


def quartile_classes(
    wide: DataFrame, cuts: DataFrame, keys: Sequence[str], measures: Sequence[str], name: str = "measure"
) -> DataFrame:
    """Each measure replaced by its class: the first cut point that is not below the value, else the number of cuts plus one.

    A null value and a measure without cut points both fall into the last class. The cut points, one short row per measure,
    are read as a scalar subquery: the wide table is only projected.
    """
    points = [c for c in cuts.columns if c.startswith("cut_")]
    known = cuts.filter(F.col(name).isin(list(measures)))
    table = known.agg(F.map_from_entries(F.collect_list(F.struct(name, F.array(*points)))).alias("m")).scalar()

    def label(measure: str) -> Column:
        mine = F.try_element_at(table, F.lit(measure))
        cases = F
        for i in range(len(points)):
            cases = cases.when(F.col(measure) <= F.get(mine, F.lit(i)), i + 1)
        return cases.otherwise(len(points) + 1).alias(measure)

    return wide.select(*keys, *[label(m) for m in measures])
