"""MLlib's random forest and boosted trees over one-hot categories, for columns of any number of categories.

MLlib keeps a number for each category of each row, so its time and memory grow with rows times categories. Here the trees are those
of ``boosting``: a level adds up the categories that rows have. The algorithm stays MLlib's: a split parts one category (a value not
seen, or null, is one of its own) from all others, by Gini impurity or variance; a child has ``min_rows`` rows at least; sibling
leaves that predict the same class are merged. A forest draws rows with replacement, and in each node the square root of the number
of categories; boosting fits means of the residuals of 2 log(1 + exp(-2 y m)) and keeps the trees up to the best loss of the rows
marked in ``stops``. Draws depend on the key and the seed, not on the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.models.boosting import BROADCAST_BYTES, FLUSH, BoostedTrees, Tree, _advanced, _grown, _margin, _Round, _Slots, category_bins
from tablejobs.sources import materialize


@dataclass
class CategoryTrees:
    columns: list[str]
    encoder: BoostedTrees  # bins of the categories; it has no trees of its own
    counts: list[int]  # categories of each column
    trees: list[Tree]
    boosted: bool

    def binned(self, df: DataFrame) -> DataFrame:
        """Input columns and ``__bins``; what was not seen, or is null, has the bin behind the last category."""
        unseen = F.array(*[F.lit(n + 1) for n in self.counts])
        return self.encoder.binned(df).withColumn("__bins", F.zip_with("__bins", unseen, lambda b, u: F.when(b > 0, b).otherwise(u)))

    def transform(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Input columns and the share of class 1."""
        trees, boosted = self.trees, self.boosted

        @F.pandas_udf("double")
        def score(bins: pd.Series) -> pd.Series:
            total = _margin(trees, np.array(bins.tolist(), np.int64).reshape(len(bins), -1), 0)
            return pd.Series(1 / (1 + np.exp(-2 * total)) if boosted else total)

        return self.binned(df).withColumn(name, score("__bins")).select(*df.columns, name)


def _prepared(df: DataFrame, label: str, key: str, columns: Sequence[str], stops: str | None, seed: int) -> tuple[CategoryTrees, DataFrame]:
    known = df.filter(F.col(label).isNotNull())
    table, sizes = category_bins(known, columns)
    encoder = BoostedTrees([], list(columns), {}, table, {c: b <= BROADCAST_BYTES for c, (_, b) in sizes.items()})
    model = CategoryTrees(list(columns), encoder, [sizes[c][0] for c in columns], [], stops is not None)
    unkeyed = F.when(F.col(key).isNull(), F.monotonically_increasing_id())  # rows without key are drawn one by one
    rows = model.binned(known).select(
        F.col(label).cast("double").alias("y"),
        F.lit(1.0).alias("w"),
        F.xxhash64(F.col(key), unkeyed, F.lit(seed)).alias("hash"),
        (F.lit(False) if stops is None else F.coalesce(F.col(stops).cast("boolean"), F.lit(False))).alias("stops"),
        F.col("__bins").alias("bins"),
        F.lit(0.0).alias("margin"),
    )
    return model, materialize(rows, "tree_rows")


def _merge_leaves(tree: Tree, share: float) -> None:
    """Sibling leaves of the same class (of the same value, with ``share`` 0) become one leaf."""
    for i in sorted(tree, reverse=True):
        if tree[i].feature is not None and all(tree[c].feature is None for c in (2 * i, 2 * i + 1)):
            left, right = tree[2 * i].value, tree[2 * i + 1].value
            if ((left > share / 2) == (right > share / 2)) if share else left == right:
                tree[i].feature = None
                del tree[2 * i], tree[2 * i + 1]


def fit_forest(
    df: DataFrame,
    label: str,
    key: str,
    columns: Sequence[str],
    trees: int = 100,
    subsample: float = 0.67,
    max_depth: int = 8,
    min_rows: int = 50,
    bootstrap: bool = True,
    all_slots: bool = False,
    seed: int = 0,
) -> CategoryTrees:
    """Mean share of class 1 over ``trees`` trees. ``all_slots`` lets a node try every category."""
    model, rows = _prepared(df, label, key, columns, None, seed)
    starts = np.cumsum([0, *[n + 1 for n in model.counts]])
    number = int(starts[-1])
    slots = None if all_slots else _Slots(starts[:-1], number, math.ceil(math.sqrt(number)))
    now = _Round([], [{} for _ in range(trees)], [[1] for _ in range(trees)], 0, subsample, seed, "share", bootstrap, slots, len(columns), number)
    model.trees = [t for t in _grown(rows, now, max_depth, 0.0, 0.0, min_rows, 1.0 / trees, None, seed, lambda _: True) if t]
    for tree in model.trees:
        _merge_leaves(tree, 1.0 / trees)
    return model


def fit_boosting(
    df: DataFrame,
    label: str,
    key: str,
    columns: Sequence[str],
    stops: str,
    max_iter: int = 50,
    learn_rate: float = 0.1,
    subsample: float = 0.5,
    max_depth: int = 5,
    min_rows: int = 50,
    tolerance: float = 0.01,
    seed: int = 0,
) -> CategoryTrees:
    """Boosted trees that end when the loss of the rows marked in ``stops`` falls by less than ``tolerance`` of itself."""
    model, rows = _prepared(df, label, key, columns, stops, seed)
    best, kept = math.nan, 1
    width = sum(model.counts) + len(columns)
    for i in range(max_iter + 1):
        done = model.trees[i - i % FLUSH :]
        if i and i % FLUSH == 0:
            rows, done = materialize(_advanced(rows, model.trees[i - FLUSH : i], 0), "tree_rows"), []
        seen: list[float] = []

        def goes_on(losses: dict[int, float]) -> bool:
            seen.append(losses.get(1, math.nan))
            falls = i < 2 or best - seen[0] >= tolerance * max(seen[0], 0.01)
            return falls and i < max_iter

        now = _Round(done, [{}], [[1]], 0, subsample, seed + 7919 * i, "residual" if i else "target", features=len(columns), width=width)
        found = _grown(rows, now, max_depth, 0.0, 0.0, min_rows, learn_rate if i else 1.0, None, seed + i, goes_on)
        if i == 1:
            best = seen[0]
        elif i > 1 and best - seen[0] >= tolerance * max(seen[0], 0.01) and seen[0] < best:
            best, kept = seen[0], i
        if found is None or not found[0]:
            break
        _merge_leaves(found[0], 0.0)
        model.trees.append(found[0])
    model.trees = model.trees[:kept]
    return model
