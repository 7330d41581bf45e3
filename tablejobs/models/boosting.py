"""Boosted trees for a 0/1 label with L1 and L2 penalties and a least child weight, from gradient and hessian sums by bin.

MLlib's boosted trees know neither penalty, and their least child is a number of rows. Here every level of a round's trees is one
aggregate: tasks add up, for each open node, feature and bin that they have rows of, the first and second derivative of the log
loss; from the sums comes the gain of every cut, for numbers by windows over their bins, which are few; and one row for each node,
its best cut, comes back. What the driver holds is the model: cut points and trees. Categories are a table, joined with the rows
once, so a column may have any number of them.

With G and H the sums of a node, T(G) = sign(G) max(|G| - l1, 0): its value is -T(G) / (H + l2), its score T(G)^2 / (H + l2), and
the gain of a cut is the score of both children less that of the parent. A child must have H of at least ``min_child_weight``.

Numbers are cut at quantiles, or at each value where there are few; categories are split one against the rest. Missing numbers,
null categories and categories not seen in the fit go to the side that the fit found better.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tablejobs.operators import prefix_sums, unpivot
from tablejobs.sources import materialize

HASH_BINS = 4096  # for the values of hashed columns
BROADCAST_BYTES = 16_000_000  # of the categories of a column, counted; larger tables are joined by shuffle
ROW_BYTES = 64  # of a category in a hash table, besides its text
SUMS = 1 << 20  # that a task gathers before it hands them on
SUMS_PER_TASK = 1 << 18  # that a task of the next step receives
FLUSH = 10  # rounds after which the margins are written, so that tasks walk few trees
SPLITS_SCHEMA = (
    "round int, tree int, node int, feature string, cut double, category string, missing_left boolean, gain double, cover double, "
    "rows long, value double"
)


@dataclass
class Node:
    """A node of a tree; node ``i`` has the children ``2 i`` and ``2 i + 1``, the root is 1."""

    gradient: float
    hessian: float
    rows: int
    value: float
    feature: int | None = None
    bin: int = 0
    missing_left: bool = False
    gain: float = 0.0


Tree = dict[int, Node]


@dataclass
class BoostedTrees:
    numeric: list[str]
    categorical: list[str]
    cuts: dict[str, list[float]]
    categories: DataFrame | None  # (feature, category, bin), bins in order of category; hashed columns have none
    listed: dict[str, bool]  # whether the categories of each column that is not hashed can be broadcast
    trees: list[list[Tree]] = field(default_factory=list)  # by round
    losses: list[float] = field(default_factory=list)  # before each round, of the rows that decide when to stop

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def binned(self, df: DataFrame) -> DataFrame:
        """Input columns and ``__bins``, the bin of each feature in a row; 0 for what is missing."""

        def number(name: str) -> Column:
            x = F.col(name).cast("double")
            cuts = F.array(*[F.lit(float(c)) for c in self.cuts[name]]).cast("array<double>")
            above = F.size(F.filter(cuts, lambda c: c < x)) + 1
            return F.when(x.isNull() | F.isnan(x), 0).otherwise(above)

        joined, found = df, [number(c) for c in self.numeric]
        for i, name in enumerate(self.categorical):
            if name not in self.listed:
                found.append(F.coalesce(F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(HASH_BINS)) + 1, F.lit(0)))
                continue
            table = self.categories.filter(F.col("feature") == name).select(F.col("category").alias(f"__c{i}"), F.col("bin").alias(f"__b{i}"))
            joined = joined.join(F.broadcast(table) if self.listed[name] else table, F.col(name).cast("string") == F.col(f"__c{i}"), "left")
            found.append(F.coalesce(F.col(f"__b{i}"), F.lit(0)))
        return joined.select(*df.columns, F.array(*[c.cast("int") for c in found]).cast("array<int>").alias("__bins"))

    def transform(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Input columns and the share of class 1."""
        trees, numbers = [t for r in self.trees for t in r], len(self.numeric)

        @F.pandas_udf("double")
        def score(bins: pd.Series) -> pd.Series:
            rows = np.array(bins.tolist(), np.int64).reshape(len(bins), -1)
            return pd.Series(1 / (1 + np.exp(-_margin(trees, rows, numbers))))

        return self.binned(df).withColumn(name, score("__bins")).select(*df.columns, name)

    def splits_table(self, spark: SparkSession) -> DataFrame:
        """A row for each node of each tree: where it is cut (left: not above ``cut``, or the ``category``), with the gain, or the
        value of a leaf. ``cover`` is the sum of the hessian. An infinite cut parts known numbers from missing ones."""
        rows = []
        for r, trees in enumerate(self.trees):
            for t, tree in enumerate(trees):
                for i, n in sorted(tree.items()):
                    cut = category = feature = None
                    if n.feature is not None:
                        feature = self.features[n.feature]
                        if feature in self.cuts:
                            cut = float([*self.cuts[feature], np.inf][n.bin - 1])
                        elif feature not in self.listed:
                            category = f"#{n.bin - 1}"
                    split = feature is not None
                    of = n.bin if feature in self.listed else None
                    rows.append((r, t, i, feature, cut, category, n.missing_left if split else None, n.gain if split else None, n.hessian, n.rows, None if split else n.value, of))
        nodes = spark.createDataFrame(rows, f"{SPLITS_SCHEMA}, bin int")
        if self.categories is None:
            return nodes.drop("bin")
        named = self.categories.select("feature", "bin", F.col("category").alias("name")).join(F.broadcast(nodes.select("feature", "bin").distinct()), ["feature", "bin"])
        found = nodes.join(F.broadcast(named), ["feature", "bin"], "left")  # at most a row for each node
        return found.withColumn("category", F.coalesce("category", "name")).select(*nodes.drop("bin").columns)

    def importance_table(self, spark: SparkSession) -> DataFrame:
        """For each input: number of splits, and mean gain and mean cover of its splits; 0 for an input without any."""
        names = spark.createDataFrame([(f,) for f in self.features], "feature string")
        splits = self.splits_table(spark).filter("feature is not null").groupBy("feature")
        found = splits.agg(
            F.count(F.lit(1)).alias("importance_weight"), F.avg("gain").alias("importance_gain"), F.avg("cover").alias("importance_cover")
        )
        return names.join(F.broadcast(found), "feature", "left").fillna(0)  # a row for each input


def _places(tree: Tree, bins: np.ndarray, numbers: int) -> np.ndarray:
    """The leaf that each row reaches."""
    size = max(tree, default=1) + 1
    feature, cut, missing_left = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool)
    for i, node in tree.items():
        if node.feature is not None:
            feature[i], cut[i], missing_left[i] = node.feature, node.bin, node.missing_left
    at = np.ones(len(bins), np.int64)
    rows = np.arange(len(bins))
    while len(rows := rows[feature[at[rows]] >= 0]):
        node = at[rows]
        own = bins[rows, feature[node]]
        inside = np.where(feature[node] < numbers, own <= cut[node], own == cut[node])
        at[rows] = 2 * node + 1 - np.where(own == 0, missing_left[node], inside)
    return at


def _margin(trees: Sequence[Tree], bins: np.ndarray, numbers: int) -> np.ndarray:
    total = np.zeros(len(bins))
    for tree in trees:
        values = np.zeros(max(tree) + 1)
        for i, node in tree.items():
            values[i] = node.value
        total += values[_places(tree, bins, numbers)]
    return total


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h.view(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).astype(np.float64) / 2.0**64


@dataclass
class _Round:
    """What tasks need for one level of a round."""

    done: list[Tree]  # since the margins were written
    growing: list[Tree]
    open: list[list[int]]
    numbers: int
    subsample: float
    salt: int
    loss: str = "log"
    bootstrap: bool = False  # a row comes as often as a Poisson number says
    slots: _Slots | None = None  # features of one category each, of which a node tries some
    features: int = 1
    width: int = 0  # bins of all features

    def partitions(self, opened: Sequence[Sequence[int]], tasks: int, most: int) -> int:
        """Into how many partitions, up to ``most``, the sums of ``opened`` go: as many as what ``tasks`` tasks hand on at most needs."""
        tried = self.width if self.slots is None else min(self.width, self.slots.tried)
        handed = 0
        for tree, nodes in zip(self.growing, opened):
            for i in nodes:
                given = tasks * (tried + 1)
                handed += min(given, tree[i].rows * (self.features + 1)) if i in tree else given  # nobody has counted the rows of a root
        return max(1, min(most, 1 + handed // SUMS_PER_TASK))


@dataclass
class _Slots:
    starts: np.ndarray  # first slot of each column
    number: int
    tried: int

    def chosen(self, seed: int, tree: int, nodes: Sequence[int]) -> np.ndarray:
        """Sorted (place of the node in ``nodes``) * ``number`` + slot."""
        draws = [np.sort(np.random.default_rng([seed, tree, n]).choice(self.number, self.tried, replace=False, shuffle=False)) for n in nodes]
        return np.concatenate([i * self.number + d for i, d in enumerate(draws)])


def _derivatives(loss: str, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient, hessian and loss of rows. ``share`` and ``target`` (of +1 or -1) make leaves of means; ``residual`` is the slope of
    2 log(1 + exp(-2 y m)), the loss of MLlib's boosting, and makes leaves of its means."""
    p = 1 / (1 + np.exp(-margin))
    if loss == "log":
        return p - y, p * (1 - p), np.maximum(margin, 0) - margin * y + np.log1p(np.exp(-np.abs(margin)))
    sign, one = 2 * y - 1, np.ones(len(y))
    if loss == "share":
        return -y, one, one
    found = 2 * np.logaddexp(0, -2 * sign * margin)
    return -sign if loss == "target" else -4 * sign / (1 + np.exp(2 * sign * margin)), one, found


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson numbers from evenly spread ones."""
    terms = np.cumprod(np.append(np.exp(-mean), mean / np.arange(1, 40)))
    return np.searchsorted(np.cumsum(terms), u, side="right").astype(np.float64)


LOSS = -1  # in place of a tree: sums of the loss over the rows that decide when to stop
ALL = -1  # in place of a feature: sums over the rows of a node
SUMS_SCHEMA = "tree int, node int, feature int, bin int, g double, h double, n long"


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (tree, node, feature, bin), as columns, and the sums of their (g, h, n)."""
    keys, values = (np.concatenate([p[i] for p in parts], axis=1) for i in (0, 1))
    order = np.lexsort(keys[::-1])
    keys, values = keys[:, order], values[:, order]
    first = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))[: keys.shape[1]])
    return keys[:, first], np.add.reduceat(values, first, axis=1) if len(first) else values


def _by_bin(nodes: np.ndarray, bins: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (node, bin) and the sums of their ``values``; counted where there are few pairs, otherwise sorted."""
    width = int(bins.max()) + 1
    pairs = nodes * width + bins
    low = int(pairs.min())
    if int(pairs.max()) - low < 4 * len(pairs) + 1024:
        used = np.flatnonzero(np.bincount(pairs - low))
        found, sums = used + low, np.array([np.bincount(pairs - low, weights=v)[used] for v in values])
    else:
        found, place = np.unique(pairs, return_inverse=True)
        sums = np.array([np.bincount(place, weights=v) for v in values])
    return found // width, found % width, sums


def _sums(state) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(tree, node, feature, bin, g, h, n) of the task's rows, only for bins with rows; a bin may come several times."""

    def record(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        columns = [*[pa.array(k.astype(np.int32)) for k in keys], pa.array(values[0]), pa.array(values[1]), pa.array(values[2].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["tree", "node", "feature", "bin", "g", "h", "n"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Round = state.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        chosen_slots: dict[int, np.ndarray] = {}  # by tree
        size = merged = 0
        for batch in batches:
            y, w, stored = (batch[c].to_numpy() for c in ("y", "w", "margin"))
            hashes, stops = batch["hash"].to_numpy(), batch["stops"].to_numpy(zero_copy_only=False)
            bins = batch["bins"].flatten().to_numpy().astype(np.int64).reshape(len(y), -1)
            margin = stored + _margin(now.done, bins, now.numbers)
            g, h, loss = (w * v for v in _derivatives(now.loss, y, margin))
            for of, chosen in ((0, ~stops), (1, stops)):
                held.append((np.array([[LOSS], [of], [0], [0]]), np.array([[loss[chosen].sum()], [w[chosen].sum()], [chosen.sum()]])))
            for t, tree in enumerate(now.growing):
                if not now.open[t]:
                    continue
                drawn = _mixed(hashes, now.salt + t)
                times = _poisson(drawn, now.subsample) if now.bootstrap else (drawn < now.subsample).astype(np.float64)
                rows = np.flatnonzero(~stops & (times > 0))
                places = _places(tree, bins[rows], now.numbers)
                inside = np.isin(places, now.open[t])
                rows, places = rows[inside], places[inside]
                many = times[rows]
                stats = np.array([g[rows] * many, h[rows] * many, many])
                nodes = np.sort(now.open[t])
                if now.slots is not None and t not in chosen_slots:
                    chosen_slots[t] = now.slots.chosen(now.salt, t, nodes.tolist())
                for f in range(ALL, bins.shape[1]):
                    own, at, part = np.zeros(len(rows), np.int64) if f == ALL else bins[rows, f], places, stats
                    if now.slots is not None and f != ALL:
                        wanted = np.searchsorted(nodes, places) * now.slots.number + now.slots.starts[f] + own - 1
                        found = np.searchsorted(chosen_slots[t], wanted)
                        hit = chosen_slots[t][np.minimum(found, len(chosen_slots[t]) - 1)] == wanted
                        own, at, part = own[hit], places[hit], stats[:, hit]
                    if len(own):
                        node, own, part = _by_bin(at, own, part)
                        held.append((np.array([np.full(len(own), t), node, np.full(len(own), f), own]), part))
                        size += len(own)
            if size > merged + SUMS:
                held = [_merged(held)]
                size = merged = held[0][0].shape[1]
                if merged > SUMS:
                    yield record(*held[0])
                    held, size, merged = [], 0, 0
        if held:
            keys, values = _merged(held)
            for at in range(0, keys.shape[1], 1 << 16):
                yield record(keys[:, at : at + (1 << 16)], values[:, at : at + (1 << 16)])

    return sums


def _score(g: Column, h: Column, l1: float, l2: float) -> Column:
    shrunk = F.greatest(F.abs(g) - l1, F.lit(0.0))
    return F.coalesce(F.try_divide(shrunk * shrunk, h + l2), F.lit(0.0))


def _local(sums: DataFrame, rows: Sequence[Row], keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Rows of ``sums`` that the driver has, with other names for their (g, h, n)."""
    columns = [pa.array([r[k] for r in rows], pa.int32()) for k in keys]
    columns += [pa.array([r[v] for r in rows], pa.int64() if v == "n" else pa.float64()) for v in "ghn"]
    return sums.sparkSession.createDataFrame(pa.table(columns, names=[*keys, *names]))


def best_cuts(
    sums: DataFrame, totals: Sequence[Row], missing: Sequence[Row], numbers: int, l1: float, l2: float, min_child_weight: float,
    columns: int | None = None, seed: int = 0,
) -> DataFrame:
    """(tree, node, best) of every node that can be cut: its best cut.

    ``sums`` has (tree, node, feature, bin, g, h, n); its rows of whole nodes are the ``totals``, those of bin 0 are ``missing``:
    there is one of each for a node and for a feature of a node. ``columns`` is the number of features tried in a node, chosen by hash.
    Equal gains (to nine digits) go to the first feature, the first bin, missing to the right.
    """
    node, slot = ["tree", "node"], ["tree", "node", "feature"]
    whole = _local(sums, totals, node, [f"{v}_all" for v in "ghn"])
    without = _local(sums, missing, slot, [f"{v}_no" for v in "ghn"])
    up = Window.partitionBy(*slot).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = sums.filter(F.col("bin") > 0)
    rows = known.filter(F.col("feature") >= numbers).select(*slot, "bin", *[F.col(v).alias(f"{v}_in") for v in "ghn"])
    if numbers:  # a few bins for each feature of a node
        summed = known.filter(F.col("feature") < numbers).select(*slot, "bin", *[F.sum(v).over(up).alias(f"{v}_in") for v in "ghn"])
        rows = rows.unionByName(summed)
    rows = rows.join(F.broadcast(whole), node).join(F.broadcast(without), slot, "left").fillna(0, [f"{v}_no" for v in "ghn"])
    if columns is not None:
        order = F.xxhash64(F.lit(seed), *slot)
        rank = F.dense_rank().over(Window.partitionBy(*node).orderBy(order, "feature"))
        tried = sums.filter(F.col("feature") >= 0).select(*slot).distinct().withColumn("rank", rank).filter(F.col("rank") <= columns)
        rows = rows.join(F.broadcast(tried.drop("rank")), slot)
    sides = F.when(F.col("n_no") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("missing_left", F.explode(sides))
    left = {v: F.col(f"{v}_in") + F.when(F.col("missing_left"), F.col(f"{v}_no")).otherwise(0) for v in ("g", "h", "n")}
    right = {v: F.col(f"{v}_all") - left[v] for v in left}
    gain = _score(left["g"], left["h"], l1, l2) + _score(right["g"], right["h"], l1, l2) - _score(F.col("g_all"), F.col("h_all"), l1, l2)
    fits = (left["n"] > 0) & (right["n"] > 0) & (gain > 1e-9)
    fits &= (left["h"] >= min_child_weight) & (right["h"] >= min_child_weight)
    cut = F.struct(
        F.round(gain, 9).alias("first"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), (~F.col("missing_left")).alias("r"),
        gain.alias("gain"), *[left[v].alias(v) for v in left],
    )
    return rows.filter(fits).groupBy(*node).agg(F.max(cut).alias("best"))


def category_bins(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """(feature, category, bin) of the distinct values, numbered from 1 in order; number and bytes of each column's."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = unpivot(texts, [], list(columns), "feature", "category").filter("category is not null").distinct()
    table = prefix_sums(long.withColumn("one", F.lit(1)), ["category"], {"bin": "one"}, by=["feature"])
    table = materialize(table.select("feature", "category", F.col("bin").cast("int").alias("bin")), "categories")
    sizes = table.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category") + ROW_BYTES).alias("b")).collect()
    found = {r["feature"]: (r["n"], r["b"]) for r in sizes}  # a row for each column
    return table, {c: found.get(c, (0, 0)) for c in columns}


def _values(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list]:
    """Distinct values of each column in order, one more than ``most`` where there are more."""
    long = unpivot(df, [], list(columns), "name").filter("value is not null").distinct()
    some = long.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy("value"))).filter(F.col("r") <= most + 1)
    found: dict[str, list] = {c: [] for c in columns}
    for row in some.collect():
        found[row["name"]].append(row["value"])
    return {c: sorted(v) for c, v in found.items()}


def _cuts(df: DataFrame, numeric: Sequence[str], max_bins: int) -> dict[str, list[float]]:
    if not numeric:
        return {}
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in numeric])
    values = _values(numbers, numeric, max_bins)
    many = [c for c in numeric if len(values[c]) > max_bins]
    if many:
        shares = [i / max_bins for i in range(1, max_bins)]
        row = numbers.agg(*[F.percentile_approx(c, shares).alias(c) for c in many]).first()
        values |= {c: sorted(set(row[c])) for c in many}
    return values


def fit_boosted(
    df: DataFrame,
    label: str,
    key: str,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    hashed: Sequence[str] = (),
    max_iter: int = 50,
    learn_rate: float = 0.1,
    max_depth: int = 6,
    l1: float = 0.0,
    l2: float = 0.0,
    min_child_weight: float = 0.0,
    subsample: float = 1.0,
    columns_per_node: float = 1.0,
    trees_per_round: int = 1,
    max_bins: int = 64,
    stops: str | None = None,
    min_rel_progress: float = 0.01,
    weight: Column | None = None,
    seed: int = 0,
) -> BoostedTrees:
    """``max_iter`` rounds of ``trees_per_round`` trees, whose values are their mean times ``learn_rate``.

    ``key`` tells rows apart: whether a row is in a tree's sample depends on it and the seed alone. Rounds end before
    ``max_iter`` when the loss of the rows marked in ``stops`` (of all rows, without such a column) falls by less than
    ``min_rel_progress`` of itself; 0 lets all rounds run. Rows marked there teach nothing. Rows without label are left out.
    ``hashed`` names categorical columns with too many values for a list.
    """
    if unknown := set(hashed) - set(categorical):
        raise ValueError(f"not among the categorical columns: {sorted(unknown)}")
    known = df.filter(F.col(label).isNotNull())
    listed = [c for c in categorical if c not in hashed]
    table, sizes = category_bins(known, listed) if listed else (None, {})
    small = {c: b <= BROADCAST_BYTES for c, (_, b) in sizes.items()}
    model = BoostedTrees(list(numeric), list(categorical), _cuts(known, numeric, max_bins), table, small)
    rows = model.binned(known).select(
        F.col(label).cast("double").alias("y"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"),
        F.xxhash64(F.col(key), F.lit(seed)).alias("hash"),
        (F.lit(False) if stops is None else F.coalesce(F.col(stops).cast("boolean"), F.lit(False))).alias("stops"),
        F.col("__bins").alias("bins"),
        F.lit(0.0).alias("margin"),
    )
    rows = materialize(rows, "boosting_rows")
    numbers, decides = len(numeric), 0 if stops is None else 1
    bins = [len(model.cuts[c]) + 1 for c in numeric] + [sizes[c][0] if c in sizes else HASH_BINS for c in categorical]
    width = sum(bins) + len(bins)  # a bin of each feature for what is missing
    columns = None if columns_per_node >= 1 else max(1, round(columns_per_node * len(model.features)))
    for i in range(max_iter):
        done = [t for r in model.trees[i - i % FLUSH :] for t in r]
        if i and i % FLUSH == 0:
            rows = materialize(_advanced(rows, [t for r in model.trees[i - FLUSH :] for t in r], numbers), "boosting_rows")
            done = []
        state = _Round(done, [{} for _ in range(trees_per_round)], [[1] for _ in range(trees_per_round)], numbers, subsample, seed + 7919 * i, features=len(bins), width=width)

        def goes_on(losses: dict[int, float]) -> bool:
            model.losses.append(losses.get(decides, 0.0))
            return not (i and min_rel_progress and model.losses[-2] - model.losses[-1] < min_rel_progress * abs(model.losses[-2]))

        trees = _grown(rows, state, max_depth, l1, l2, min_child_weight, learn_rate / trees_per_round, columns, seed + i, goes_on)
        if trees is None or not any(trees):  # no progress, or no rows
            return model
        model.trees.append([t or {1: Node(0.0, 0.0, 0, 0.0)} for t in trees])  # a sample may be empty
    return model


def _grown(
    rows: DataFrame, now: _Round, max_depth: int, l1: float, l2: float, min_child_weight: float, rate: float, columns: int | None, seed: int,
    goes_on: Callable[[dict[int, float]], bool],
) -> list[Tree] | None:
    """The trees of a round, level by level; none if ``goes_on`` says no to the mean losses by ``stops`` (0 and 1) before it.

    A level has few sums beside the rows, and several short steps read them: their partitions follow them, not the session's number.
    """
    trees, opened = now.growing, now.open
    tasks, most = rows.rdd.getNumPartitions(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for depth in range(max_depth):
        state = rows.sparkSession.sparkContext.broadcast(replace(now, open=opened))
        parts = rows.mapInArrow(_sums(state), SUMS_SCHEMA)
        bin_of = ["tree", "node", "feature", "bin"]
        dealt = parts.repartition(now.partitions(opened, tasks, most), *bin_of)
        sums = dealt.groupBy(*bin_of).agg(*[F.sum(v).alias(v) for v in "ghn"]).persist()  # read several times
        few = sums.filter((F.col("feature") == ALL) | (F.col("bin") == 0)).collect()  # for open nodes and their features
        if depth == 0 and not goes_on({r["node"]: r["g"] / r["h"] for r in few if r["tree"] == LOSS and r["h"]}):
            sums.unpersist()
            return None
        totals = [r for r in few if r["feature"] == ALL]
        missing = [r for r in few if r["tree"] != LOSS and r["feature"] != ALL]
        cuts = best_cuts(sums, totals, missing, now.numbers, l1, l2, min_child_weight, columns, seed)
        found = {(r["tree"], r["node"]): r["best"] for r in cuts.collect()}  # a row for each open node
        sums.unpersist()
        opened = [[] for _ in trees]
        for r in totals:
            tree, node = trees[r["tree"]], r["node"]
            if node == 1:
                tree[1] = _node(r["g"], r["h"], r["n"], l1, l2, rate)
            best = found.get((r["tree"], node))
            if best is None:
                continue
            parent = tree[node]
            parent.feature, parent.bin, parent.missing_left, parent.gain = -best["f"], -best["b"], not best["r"], best["gain"]
            tree[2 * node] = _node(best["g"], best["h"], best["n"], l1, l2, rate)
            rest = (r["g"] - best["g"], r["h"] - best["h"], r["n"] - best["n"])
            tree[2 * node + 1] = _node(*rest, l1, l2, rate)
            opened[r["tree"]] += [2 * node, 2 * node + 1]
        if not any(opened):
            break
    return trees


def _node(g: float, h: float, n: int, l1: float, l2: float, rate: float) -> Node:
    shrunk = np.sign(g) * max(abs(g) - l1, 0.0)
    return Node(g, h, n, float(-rate * shrunk / (h + l2)) if h + l2 > 0 else 0.0)


def _advanced(rows: DataFrame, trees: list[Tree], numbers: int) -> DataFrame:
    """The rows with the trees' values added to their margins."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch["bins"].flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
            margin = batch["margin"].to_numpy() + _margin(shared.value, bins, numbers)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return rows.mapInArrow(advance, rows.schema)
