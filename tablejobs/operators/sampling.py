"""Random choices that do not depend on partitioning: a row is chosen by the md5 of its key and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 3  # hexadecimal digits per count: 4,096 equal classes


def _digest(key: str, seed: str) -> Column:
    """Null keys count as the empty text, so that every row has a place."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)))


def _below(key: str, fraction: float, seed: str) -> Column:
    if fraction >= 1:
        return F.lit(True)
    return F.substring(_digest(key, seed), 1, 15) < f"{max(0, round(fraction * 16**15)):015x}"


def hash_fraction(df: DataFrame, key: str, fraction: float, seed: str = "") -> DataFrame:
    """About ``fraction`` of the rows, in place of ``rand() < fraction``."""
    return df.filter(_below(key, fraction, seed))


def hash_split(df: DataFrame, key: str, eval_fraction: float, seed: str = "", name: str = "is_eval") -> DataFrame:
    """Mark the evaluation share, so that later steps know which rows a model has not seen."""
    return df.withColumn(name, _below(key, eval_fraction, seed))


def _last_open(counts: DataFrame, digits: str, n: int, before: Column | int) -> Column:
    """Last class, in order of digits, that starts before row ``n``, and the rows before it; ``counts`` has at most 4,096 rows."""
    earlier = Window.orderBy(digits).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(digits, (F.coalesce(F.sum("c").over(earlier), F.lit(0)) + before).alias("b"))
    return starts.filter(F.col("b") < n).agg(F.max(F.struct(digits, "b")).alias("e")).scalar()


def hash_sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), in place of ``ORDER BY rand() LIMIT n``. ``key`` must be unique.

    Two counts, by the first digits of the digest and, inside one class of those, by the next ones, tell up to which digits
    the n smallest digests reach; so hardly more than n rows of the whole table come to the final ordering. ``df`` is read
    three times: write it first if it is costly.
    """
    hashed = df.withColumn("__md5", _digest(key, seed))
    first, second = F.substring("__md5", 1, DIGITS), F.substring("__md5", 1 + DIGITS, DIGITS)
    coarse = hashed.groupBy(first.alias("p")).agg(F.count(F.lit(1)).alias("c"))
    edge = _last_open(coarse, "p", n, 0)
    within = hashed.filter(first == edge["p"]).groupBy(second.alias("q")).agg(F.count(F.lit(1)).alias("c"))
    last = _last_open(within, "q", n, edge["b"])
    kept = hashed.filter((first < edge["p"]) | ((first == edge["p"]) & (second <= last["q"])))
    return kept.orderBy("__md5", key).limit(n).drop("__md5")
