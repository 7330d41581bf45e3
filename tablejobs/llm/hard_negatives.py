"""Hard negatives: rows of another label that score nearly as high with an anchor as its positives do, exactly.

Components are scaled to whole numbers, and a score is the inner product with the anchor. Candidates lie in Parquet blocks of
``BLOCK_ROWS`` rows in the order of a Hilbert curve through all dimensions, so that a block holds rows close to each other.
Each block has a zone map: the smallest and largest value of every dimension, and its labels. Interval arithmetic on it bounds
the score of any of its rows with an anchor, from below and from above. An anchor reads only blocks whose bounds meet one of its
windows of scores:

1. probe: the ``PROBE`` blocks of the anchor's label with the highest upper bound give a first k-th best positive score;
2. positives: blocks whose upper bound reaches it;
3. negatives: blocks with other labels whose bounds meet the window of scores below a positive.

Anchors come in slices of at most about ``SLICE_BYTES`` along the same curve; a slice is broadcast, zone maps choose its blocks, and
only those are read. Tasks keep the best few rows of each window. How much is skipped depends on the data alone; nothing is
skipped that could matter, so the result is exact whatever the order of the blocks.

Rows without id, label or vector, and rows with a null or non-finite component take no part. Of rows with the same id the one
with the smallest label and components stays. Only vectors of the same length are compared. No anchors, no rows or no other
labels give no result rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm.shared import join_ids, written

SCALE = 256
BLOCK_ROWS = 256
PROBE = 2
POSITIVES = 5
NEGATIVES = 5
SHARE = (80, 100)  # a negative scores between SHARE[0] / SHARE[1] of the positive's score and that score
SLICE_BYTES = 8_000_000
PART_BYTES = 64_000_000
CURVE_BITS = 256  # of a place on the curve, as far as a bit for each dimension allows
AT_ONCE = 1024  # anchors scored with a block at a time
PENDING = 100_000  # rows of windows kept before only the best stay
RUNS = 64  # ranges of blocks in a filter
LISTED = 20_000  # blocks that such a filter is made from; more are joined
NONE, MOST = -(2**62), 2**62

Batches = Iterator[pa.RecordBatch]


def curve_places(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (whole numbers below ``2 ** bits`` in every column) on the Hilbert curve, as rows of bytes."""
    x = points.astype(np.uint32).T.copy()
    dims = len(x)
    if not dims:
        return np.zeros((points.shape[0], 0), np.uint8)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for axis in x:
            inside = (axis & high) != 0
            swap = np.where(inside, np.uint32(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(inside, low, swap)
            if axis is not x[0]:
                axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((x[None] >> levels[:, None, None]) & 1).reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def _quantised(batches: Batches) -> Batches:
    """The rows with whole components."""
    for batch in batches:
        lists = batch["vector"]
        whole = np.floor(lists.flatten().to_numpy() * SCALE)
        parts = np.split(whole, np.cumsum(lists.value_lengths().to_numpy())[:-1])
        columns = [
            *(batch[c] for c in ("id", "label", "anchor")),
            pa.array([len(p) for p in parts], pa.int32()),
            pa.array([float(np.abs(p).max(initial=0)) for p in parts], pa.float64()),
            pa.array([(p.astype("<i4") if np.abs(p).max(initial=0) < 2**31 else p.astype("<f8")).tobytes() for p in parts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label", "anchor", "dim", "peak", "vector"])


QUANTISED = "id long, label long, anchor boolean, dim int, peak double, vector binary"


def _vector(value: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(value, "<i4" if len(value) == 4 * dim else "<f8").astype(np.float64)


def _curve(bound: float) -> Callable[[Batches], Batches]:
    """The rows with their place on the curve; components beyond the bound count as the bound."""

    def curve(batches: Batches) -> Batches:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            places: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                bits = max(1, min(16, CURVE_BITS // max(dim, 1)))
                points = np.array([_vector(batch["vector"][i].as_py(), dim) for i in rows.tolist()]).reshape(len(rows), dim)
                cells = (np.clip(points, -bound, bound) + bound) / (2 * bound) * (2**bits - 1) if bound else points * 0
                for i, place in zip(rows.tolist(), curve_places(np.rint(cells), bits), strict=True):
                    places[i] = place.tobytes()
            yield batch.append_column("place", pa.array(places, pa.binary()))

    return curve


BLOCK = "dim int, low binary, high binary, labels array<long>, ids binary, of binary, vectors binary"


def _blocks(batches: Batches) -> Batches:
    """Blocks of rows that follow each other, each sorted by id, with their zone maps."""
    held: list[tuple[int, int, int, bytes]] = []

    def block() -> pa.RecordBatch:
        held.sort(key=lambda r: r[1])
        dim = held[0][0]
        points = np.array([_vector(r[3], dim) for r in held]).reshape(len(held), dim)
        low, high = points.min(axis=0), points.max(axis=0)
        small = np.abs(points).max(initial=0) < 2**15
        row = {
            "dim": dim, "low": low.tobytes(), "high": high.tobytes(), "labels": sorted({r[2] for r in held}),
            "ids": np.array([r[1] for r in held], np.int64).tobytes(), "of": np.array([r[2] for r in held], np.int64).tobytes(),
            "vectors": points.astype("<i2" if small else "<f8").tobytes(),
        }
        held.clear()
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("dim", "id", "label", "vector")), strict=True):
            if held and (len(held) == BLOCK_ROWS or row[0] != held[0][0]):
                yield block()
            held.append(row)
    if held:
        yield block()


@dataclass
class Anchors:
    """Anchors of one slice and one length, with windows of scores (a row for each anchor)."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    same: bool  # windows ask for rows of the anchor's label, or of the others
    low: np.ndarray
    high: np.ndarray
    names: np.ndarray  # of each window, for the result
    best: int
    chosen: dict[int, np.ndarray] | None = None  # anchors of each block that is read, where these are given

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with any point of each zone."""
        up, down = np.maximum(self.points, 0), np.minimum(self.points, 0)
        slack = 1e-12 * (np.abs(self.points) @ np.maximum(np.abs(low), np.abs(high)).T)  # of sums that are no longer exact
        return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack

    def fitting(self, labels: list[list[int]]) -> np.ndarray:
        """Whether each block has rows of a label that each anchor asks for."""
        found = np.zeros((len(self.ids), len(labels)), bool)
        for i, names in enumerate(labels):
            found[:, i] = np.isin(self.labels, names) if self.same else len(names) > 1 or self.labels != names[0]
        return found

    def needed(self, low: np.ndarray, high: np.ndarray, labels: list[list[int]]) -> np.ndarray:
        least, most = self.bounds(low, high)
        meets = np.zeros(least.shape, bool)
        for j in range(self.low.shape[1]):
            a, b = self.low[:, j, None], self.high[:, j, None]
            meets |= (a <= b) & (most >= a) & (least <= b)
        return meets & self.fitting(labels)

    def scores(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        a = self.points[rows]
        if np.abs(a).max(initial=0) * np.abs(points).max(initial=0) * a.shape[1] < 2**53:
            return (a @ points.T).astype(np.int64)
        whole = [[int(x) for x in p] for p in points]
        exact = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in whole] for p in ([int(x) for x in r] for r in a)]
        if any(abs(s) >= MOST for r in exact for s in r):
            raise OverflowError("scores of these vectors need more than 62 bits")
        return np.array(exact, np.int64).reshape(len(a), len(points))


def _zones(batch: pa.RecordBatch, anchors: Anchors) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]]:
    """(block numbers, low, high, labels) of the zones with as many dimensions as the anchors, some at a time."""
    dim = anchors.points.shape[1]
    rows = np.flatnonzero(batch["dim"].to_numpy() == dim)
    for part in np.array_split(rows, len(rows) * len(anchors.ids) // 2_000_000 + 1) if len(rows) else []:
        taken = batch.take(pa.array(part))
        low, high = (np.array([np.frombuffer(x.as_py(), "<f8") for x in taken[c]]).reshape(len(part), dim) for c in ("low", "high"))
        yield taken["block"].to_numpy(), low, high, taken["labels"].to_pylist()


def _probe(slices) -> Callable[[Batches], Batches]:
    """(part, anchor, block, upper): the blocks of the anchor's label with the highest upper bounds in the task."""

    def probe(batches: Batches) -> Batches:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, anchors in enumerate(slices.value):
                for block, low, high, labels in _zones(batch, anchors):
                    upper = np.where(anchors.fitting(labels), anchors.bounds(low, high)[1], -np.inf)
                    names = np.broadcast_to(block, upper.shape)
                    if k in best:
                        upper, names = np.hstack([best[k][0], upper]), np.hstack([best[k][1], names])
                    order = np.argsort(-upper, axis=1, kind="stable")[:, :PROBE]
                    best[k] = np.take_along_axis(upper, order, 1), np.take_along_axis(names, order, 1)
        for k, (upper, names) in best.items():
            row, column = np.nonzero(np.isfinite(upper))
            columns = [np.full(len(row), k, np.int64), row.astype(np.int64), names[row, column], upper[row, column]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "anchor", "block", "upper"])

    return probe


def _needed(slices) -> Callable[[Batches], Batches]:
    """(block) that some anchor must read."""

    def needed(batches: Batches) -> Batches:
        for batch in batches:
            for anchors in slices.value:
                for block, low, high, labels in _zones(batch, anchors):
                    found = block[anchors.needed(low, high, labels).any(axis=0)]
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["block"])

    return needed


class _Best:
    """The best rows of every window seen so far: highest score first, then smallest id."""

    def __init__(self, anchors: Anchors):
        self.anchors, self.width = anchors, anchors.low.shape[1]
        self.floor = anchors.low.copy()
        self.rows = [np.zeros(0, np.int64) for _ in range(3)]  # window, score, id
        self.pending: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        floor, high = self.floor[rows], self.anchors.high[rows]
        r, c = np.nonzero(fits & (scores >= floor.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None]))
        s, names = scores[r, c], ids[c]
        for j in range(self.width):
            inside = (s >= floor[r, j]) & (s <= high[r, j])
            self.pending.append([rows[r[inside]] * self.width + j, s[inside], names[inside]])
            self.n += int(inside.sum())
        if self.n > PENDING:
            self.prune()

    def prune(self) -> list[np.ndarray]:
        window, score, name = (np.concatenate(x) for x in zip(self.rows, *self.pending, strict=True))
        order = np.lexsort((name, -score, window))
        window, score, name = window[order], score[order], name[order]
        first = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(first, np.diff(np.r_[first, len(window)]))
        last = rank == self.anchors.best - 1
        floor = self.floor.reshape(-1)
        floor[window[last]] = score[last]
        kept = rank < self.anchors.best
        self.rows, self.pending, self.n = [window[kept], score[kept], name[kept]], [], 0
        return self.rows


SCORED = "anchor_id long, name long, score long, id long"


def _scored(slices) -> Callable[[Batches], Batches]:
    """The best rows of each window in the blocks of the task."""

    def scored(batches: Batches) -> Batches:
        best = [_Best(anchors) for anchors in slices.value]
        for batch in batches:
            for i, dim in enumerate(batch["dim"].to_pylist()):
                for found in best:
                    anchors = found.anchors
                    if anchors.points.shape[1] != dim:
                        continue
                    low, high = (np.frombuffer(batch[c][i].as_py(), "<f8")[None] for c in ("low", "high"))
                    if anchors.chosen is not None:
                        rows = anchors.chosen.get(batch["block"][i].as_py(), np.zeros(0, np.int64))
                    else:
                        rows = np.flatnonzero(anchors.needed(low, high, [batch["labels"][i].as_py()])[:, 0])
                    if not len(rows):
                        continue
                    ids, of = (np.frombuffer(batch[c][i].as_py(), np.int64) for c in ("ids", "of"))
                    data = batch["vectors"][i].as_py()
                    points = np.frombuffer(data, "<i2" if len(data) == 2 * dim * len(ids) else "<f8").astype(np.float64).reshape(len(ids), dim)
                    for part in np.array_split(rows, len(rows) // AT_ONCE + 1):
                        same = anchors.labels[part, None] == of
                        fits = same & (anchors.ids[part, None] != ids) if anchors.same else ~same
                        found.add(part, anchors.scores(part, points), ids, fits)
        for found in best:
            window, score, name = found.prune()
            row, column = window // found.width, window % found.width
            columns = [found.anchors.ids[row], found.anchors.names[row, column], score, name]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "name", "score", "id"])

    return scored


def _top(rows: DataFrame, best: int) -> DataFrame:
    """The best of what the tasks have found for each window, with their rank."""
    order = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "id")  # at most ``best`` rows of each task
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _chosen_blocks(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """The blocks with these numbers; ranges of numbers are pushed down to the files."""
    found = [r["block"] for r in names.limit(LISTED + 1).collect()]
    if len(found) > LISTED:
        return join_ids(blocks, names, "block", "left_semi")
    if not found:
        return blocks.where("false")
    order = np.sort(np.array(found))
    cuts = np.sort(np.argsort(-np.diff(order), kind="stable")[: RUNS - 1])
    cuts = cuts[np.diff(order)[cuts] > 1]
    ranges = zip(order[np.r_[0, cuts + 1]].tolist(), order[np.r_[cuts, len(order) - 1]].tolist(), strict=True)
    return blocks.where(" or ".join(f"block between {a} and {b}" for a, b in ranges))


class Index:
    """Vectors in blocks along the curve. ``blocks`` has a row for each block, ``anchors`` a row for each anchor with its slice."""

    def __init__(self, vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"):
        given = vectors.select(
            vectors[id_col].cast("long").alias("id"),
            vectors[label_col].cast("long").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
            vectors[vector_col].cast("array<double>").alias("vector"),
        )
        finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) <= 1.7976931348623157e308D)"
        given = given.where(f"id is not null and label is not null and vector is not null and {finite}")
        if not given.groupBy("id").count().where("count > 1").isEmpty():
            one = F.min(F.struct("label", "vector", "anchor")).alias("one")
            given = given.groupBy("id").agg(one).select("id", "one.*")
        rows = written(given.mapInArrow(_quantised, QUANTISED), "negatives_rows")
        found = rows.agg(F.percentile_approx("peak", 0.5).alias("bound"), F.count("*").alias("n"), F.max("dim").alias("dim"), F.count_if("anchor").alias("anchors")).first()
        n, dim = found["n"], max(found["dim"] or 1, 1)
        placed = rows.mapInArrow(_curve(found["bound"] or 0.0), f"{QUANTISED}, place binary")
        parts = max(1, min(n // (8 * BLOCK_ROWS), 1000), 8 * n * dim // PART_BYTES)
        ordered = placed.repartitionByRange(parts, "dim", "place", "id").sortWithinPartitions("dim", "place", "id")
        blocks = ordered.select("dim", "id", "label", "vector").mapInArrow(_blocks, BLOCK)
        self.blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "negatives_blocks")
        self.slices = max(1, math.ceil(found["anchors"] * 8 * dim / SLICE_BYTES))
        anchors = placed.where("anchor").repartitionByRange(self.slices, "dim", "place", "id")
        self.anchors = written(anchors.select("id", "label", "dim", "vector", F.spark_partition_id().alias("slice")), "negatives_anchors")
        self.spark = vectors.sparkSession

    def _slice(self, number: int, k: int) -> list[Anchors]:
        """The anchors of a slice, by length, asking for the ``k`` best rows of their label."""
        rows = self.anchors.where(F.col("slice") == number).orderBy("dim", "id").collect()
        found = []
        for dim in sorted({r["dim"] for r in rows}):
            own = [r for r in rows if r["dim"] == dim]
            ids, labels = (np.array([r[c] for r in own], np.int64) for c in ("id", "label"))
            points = np.array([_vector(bytes(r["vector"]), dim) for r in own]).reshape(len(own), dim)
            one = np.ones((len(own), 1), np.int64)
            found.append(Anchors(ids, labels, points, True, NONE * one, MOST * one, 0 * one, k))
        return found

    def _search(self, slices: list[Anchors], chosen: DataFrame | None = None) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(slices)
        if chosen is None:
            zones = self.blocks.select("block", "dim", "low", "high", "labels")
            chosen = written(zones.mapInArrow(_needed(shared), "block long").distinct(), "negatives_chosen")
        return _top(_chosen_blocks(self.blocks, chosen).mapInArrow(_scored(shared), SCORED), slices[0].best)

    def _with_floor(self, slices: list[Anchors], rows: list) -> list[Anchors]:
        """Windows from the k-th best score found so far on, where there are as many."""
        for anchors in slices:
            kth = {r["anchor_id"]: r["score"] for r in rows if r["rank"] == anchors.best}
            anchors.low = np.array([[kth.get(i, NONE)] for i in anchors.ids.tolist()], np.int64)
            anchors.chosen = None
        return slices

    def _positives(self, slices: list[Anchors]) -> list:
        """(anchor_id, score, id, rank) of the positives: at most ``k`` for each anchor of the slice."""
        zones = self.blocks.select("block", "dim", "low", "high", "labels")
        shared = self.spark.sparkContext.broadcast(slices)
        order = Window.partitionBy("part", "anchor").orderBy(F.desc("upper"), "block")
        probed = zones.mapInArrow(_probe(shared), "part long, anchor long, block long, upper double")
        probed = probed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROBE)
        probed = written(probed.select("part", "anchor", "block"), "negatives_probed")
        for k, anchors in enumerate(slices):
            anchors.chosen = {}
            for r in probed.where(F.col("part") == k).groupBy("block").agg(F.sort_array(F.collect_list("anchor")).alias("rows")).collect():
                anchors.chosen[r["block"]] = np.array(r["rows"], np.int64)
        first = self._search(slices, probed.select("block").distinct()).collect()
        return self._search(self._with_floor(slices, first)).collect()

    def mine(self, positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = SHARE) -> DataFrame:
        """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module."""
        result = self.spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        for number in range(self.slices):
            slices = self._slice(number, positives)
            if not slices:
                continue
            found: dict[int, list] = {}
            for r in self._positives(slices):
                found.setdefault(r["anchor_id"], []).append((r["rank"], r["id"], r["score"]))
            for anchors in slices:
                anchors.same, anchors.best = False, negatives
                anchors.low = np.full((len(anchors.ids), positives), 1, np.int64)  # low beyond high: a window without scores
                anchors.high, anchors.names = np.zeros_like(anchors.low), np.zeros_like(anchors.low)
                for i, name in enumerate(anchors.ids.tolist()):
                    for rank, positive, score in found.get(name, []):
                        anchors.low[i, rank - 1] = -((-share[0] * score) // share[1])
                        anchors.high[i, rank - 1], anchors.names[i, rank - 1] = score, positive
            scores = [(a, p, s) for a, own in found.items() for _, p, s in own]
            named = self.spark.createDataFrame(scores, "anchor_id long, name long, positive_score long")
            rows = self._search(slices).join(F.broadcast(named), ["anchor_id", "name"])  # the positives of a slice
            rows = rows.select("anchor_id", F.col("name").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            result = result.unionByName(written(rows, "negatives_found"))
        return result
