"""K-means segments over standardised columns.

Equal rows are merged and weighted, and several numbers of segments are fitted side by side: a pass over the merged rows moves the
centroids of all of them, so the number of passes does not depend on how many are tried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.models.metrics import assign_clusters
from tablejobs.models.training import ROWS_PER_TASK
from tablejobs.operators import hash_sample
from tablejobs.sources import materialize

START_ROWS = 2_000  # distinct rows, chosen by hash, among which the first centroids are drawn
STARTS = 8
MAX_PASSES = 50
MOVED = 1e-4  # centroids that move less than this (squared, in deviations) have settled


@dataclass
class Segments:
    features: list[str]
    means: list[float]
    deviations: list[float]
    centroids: list[list[float]]  # on the standardised scale
    davies_bouldin_index: float | None = None

    def assign(self, df: DataFrame) -> DataFrame:
        """Input columns with ``centroid_id`` (from 1) and the distance to that centroid, from literals only."""
        z = [
            (F.coalesce((F.col(f) - m) / s, F.lit(0.0)) if s else F.lit(0.0)).alias(f"__z{i}")
            for i, (f, m, s) in enumerate(zip(self.features, self.means, self.deviations))
        ]
        names = [f"__z{i}" for i in range(len(z))]
        return assign_clusters(df.select("*", *z), names, self.centroids).drop(*names)


def _nearest(points: Sequence[Sequence[float]]) -> Column:
    """(squared distance, place) of the nearest of ``points`` to the array ``z``; the first of equals.

    The points go in as one text, so that every pass runs the same compiled plan.
    """
    text = ";".join(",".join(map(repr, p)) for p in points)
    centers = F.transform(F.split(F.lit(text), ";"), lambda p: F.split(p, ",").cast("array<double>"))

    def apart(center: Column) -> Column:
        squares = F.zip_with("z", center, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda a, b: a + b)

    return F.array_min(F.transform(centers, lambda c, i: F.struct(apart(c).alias("d"), i.alias("at"))))


def _pass(rows: DataFrame, tried: dict[int, np.ndarray]) -> dict[int, dict[int, tuple[float, float, np.ndarray]]]:
    """For each k and each of its centroids with rows: number of rows, sum of distances, sum of places. One aggregate for all k."""
    width = next(iter(tried.values())).shape[1]
    found = [F.struct(F.lit(k).alias("k"), _nearest(c.tolist()).alias("near")) for k, c in tried.items()]
    spread = rows.select("z", "n", F.explode(F.array(*found)).alias("f"))
    sums = spread.groupBy("f.k", "f.near.at").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.sqrt("f.near.d")).alias("d"),
        F.array(*[F.sum(F.col("n") * F.get("z", F.lit(i))) for i in range(width)]).alias("z"),
    )
    result: dict[int, dict[int, tuple[float, float, np.ndarray]]] = {k: {} for k in tried}
    for r in sums.collect():  # a row for each centroid
        result[r["k"]][r["at"]] = (r["n"], r["d"], np.array(r["z"]))
    return result


def _start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """First centroids, each drawn in proportion to number and squared distance from those before; fewer where no place is left.
    Of STARTS draws the one that leaves the least distance."""
    draw = np.random.default_rng(seed)
    tried = []
    for _ in range(STARTS):
        chosen = [points[draw.choice(len(points), p=weights / weights.sum())]]
        apart = weights * ((points - chosen[0]) ** 2).sum(axis=1)
        while len(chosen) < k and apart.sum() > 0:
            chosen.append(points[draw.choice(len(points), p=apart / apart.sum())])
            apart = np.minimum(apart, weights * ((points - chosen[-1]) ** 2).sum(axis=1))
        tried.append((float(apart.sum()), np.array(chosen)))
    return min(tried, key=lambda t: t[0])[1]


def _index(centers: np.ndarray, sums: dict[int, tuple[float, float, np.ndarray]]) -> float | None:
    """Davies-Bouldin index of the centroids that have rows; none for less than two."""
    spread = {at: d / n for at, (n, d, _) in sums.items()}
    worst = []
    for i in spread:
        gaps = {j: float(np.linalg.norm(centers[i] - centers[j])) for j in spread if j != i}
        ratios = [(spread[i] + spread[j]) / gap for j, gap in gaps.items() if gap]
        worst += [max(ratios)] if ratios else []
    return sum(worst) / len(worst) if worst else None


def fit_all(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 0) -> list[Segments]:
    """K-means over the standardised features for every k of ``ks``, with the Davies-Bouldin index of each.

    A missing number counts as the mean, as it does in ``Segments.assign``. Equal rows are merged first. The first centroids
    come from START_ROWS of the distinct rows; all rows move them, until no centroid of any k moves any more or MAX_PASSES are
    over. A centroid without rows stays where it is; with fewer distinct rows than k there are fewer centroids. What reaches the
    driver are START_ROWS rows and the sums of each centroid. Without rows there is nothing to fit, which is an error.
    """
    numbers = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    width = range(len(features))
    found = numbers.agg(*[F.avg(f"f{i}").alias(f"m{i}") for i in width], F.count(F.lit(1)).alias("n")).first()
    if not found["n"] or not ks:
        raise ValueError("no rows, or no number of segments, to fit")
    means = [found[f"m{i}"] or 0.0 for i in width]
    filled = numbers.select(*[F.coalesce(f"f{i}", F.lit(m)).alias(f"f{i}") for i, m in enumerate(means)])
    merged = materialize(filled.groupBy(*filled.columns).agg(F.count(F.lit(1)).alias("n")), "merged")
    n = found["n"]
    squares = merged.agg(*[F.sum(F.col("n") * (F.col(f"f{i}") - m) * (F.col(f"f{i}") - m)).alias(f"s{i}") for i, m in enumerate(means)]).first()
    deviations = [(squares[f"s{i}"] / (n - 1)) ** 0.5 if n > 1 else 0.0 for i in width]
    z = [(F.col(f"f{i}") - m) / s if s else F.lit(0.0) for i, (m, s) in enumerate(zip(means, deviations))]
    rows = merged.select(F.array(*z).alias("z"), "n").withColumn("key", F.to_json("z")).persist()
    try:
        few = rows.drop("key").coalesce(rows.count() // ROWS_PER_TASK + 1)  # passes over few rows need few tasks
        start = sorted((r["z"], r["n"]) for r in hash_sample(rows, "key", START_ROWS, str(seed)).select("z", "n").collect())
        points, weights = np.array([p for p, _ in start]), np.array([w for _, w in start], float)
        fits = {k: _start(points, weights, k, seed) for k in dict.fromkeys(ks)}
        open_ks = set(fits)
        for _ in range(MAX_PASSES):
            sums = _pass(few, {k: fits[k] for k in sorted(open_ks)})
            for k, parts in sums.items():
                moved = fits[k].copy()
                for at, (count, _, total) in parts.items():
                    moved[at] = total / count
                if ((moved - fits[k]) ** 2).sum(axis=1).max() < MOVED**2:
                    open_ks.discard(k)
                fits[k] = moved
            if not open_ks:
                break
        last = _pass(few, fits)
    finally:
        rows.unpersist()
    return [Segments(list(features), means, deviations, fits[k].tolist(), _index(fits[k], last[k])) for k in ks]


def fit_segments(df: DataFrame, features: Sequence[str], k: int, seed: int = 0) -> Segments:
    """K-means for one k; see ``fit_all``."""
    return fit_all(df, features, [k], seed)[0]


def select_segments(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = (3, 4, 5), seed: int = 0
) -> tuple[Segments, list[Segments]]:
    """Fit every k and keep the lowest Davies-Bouldin index: (best, all). This is also the way when no k is given."""
    tried = fit_all(df, features, ks, seed)
    return min(tried, key=lambda s: float("inf") if s.davies_bouldin_index is None else s.davies_bouldin_index), tried
