"""Hard negatives against brute force; the curve; what zone maps leave out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs.llm import hard_negatives as hn


def brute(rows, k=5, share=(80, 100)):
    seen = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen[i] = min(seen.get(i, (label, v)), (label, v))
    seen = {i: (label, tuple(math.floor(256 * x) for x in v)) for i, (label, v) in seen.items()}
    found = []
    for a in sorted(seen):
        if a % 3:
            continue
        label, q = seen[a]
        scores = [(-sum(x * y for x, y in zip(q, r)), i, own) for i, (own, r) in seen.items() if i != a and len(r) == len(q)]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:k]:
            inside = sorted(x for x in scores if x[2] != label and share[0] * -s <= share[1] * -x[0] <= share[1] * -s)
            found += [(a, p, r + 1, i, -s, -n) for r, (n, i, _) in enumerate(inside[:k])]
    return sorted(found)


def frame(spark, rows):
    typed = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    return typed.selectExpr("*", "1 as id", "2 as block", "'x' as vector", "true as anchor")


def mined(spark, rows):
    return sorted(tuple(r) for r in hn.Index(frame(spark, rows), F.col("vec_id") % 3 == 0).mine().collect())


def some(n, dim, seed, spread=1.0):
    rng = np.random.RandomState(seed)
    return [(i, (rng.randn(dim) * spread).tolist(), int(rng.randint(4))) for i in range(n)]


CASES = {
    "random": some(700, 8, 1),
    "ties and copies": [(i, [float(i % 3), 1.0, float(i % 2)], i % 5) for i in range(200)],
    "odd": some(60, 3, 2) + [
        (None, [1.0, 1.0, 1.0], 1), (900, None, 1), (903, [1.0, None, 0.0], 1), (906, [1.0, math.inf, 0.0], 2), (909, [math.nan, 0.0, 0.0], 2),
        (912, [0.5, 0.5, 0.5], None), (915, [], 1), (918, [], 2), (921, [], 1), (924, [1.0, 2.0], 1), (925, [1.0, 2.0], 1), (926, [1.0, 1.9], 2),
        (3, [9.0, 9.0, 9.0], 0), (3, [9.0, 9.0, 9.0], 0), (6, [1e6, -1e6, 1e6], 0), (7, [1e6, -1e6, 9e5], 1), (8, [1e6, -1e6, 1e6], 0),
    ],
    "one label": [(i, [float(i)], 1) for i in range(20)],
    "negative scores": [(i, [1.0 if i % 2 else -1.0, 0.0], i % 4 // 2) for i in range(24)],
    "no anchors": [(1, [1.0], 1), (2, [1.0], 2)],
}


@pytest.mark.parametrize("name", CASES)
def test_same_as_brute_force(spark, name):
    assert mined(spark, CASES[name]) == brute(CASES[name])


def test_many_slices(spark, monkeypatch):
    monkeypatch.setattr(hn, "SLICE_BYTES", 5_000)
    rows = some(400, 8, 3)
    assert mined(spark, rows) == brute(rows)


def test_many_chosen_blocks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(hn, "LISTED", 0)
    rows = some(400, 4, 4)
    assert mined(spark, rows) == brute(rows)


def test_no_rows(spark):
    index = hn.Index(frame(spark, CASES["one label"]).limit(0), F.col("vec_id") % 3 == 0)
    assert index.mine().count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    places = [p.tobytes() for p in hn.curve_places(grid, bits)]
    path = grid[sorted(range(len(grid)), key=places.__getitem__)]
    assert len(set(places)) == len(grid)
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_leave_out_far_blocks(spark, monkeypatch):
    rng = np.random.RandomState(6)
    centres = [[8.0, 0.0], [0.0, 8.0], [-8.0, 0.0], [0.0, -8.0]]
    rows = [(i, (np.array(centres[i // 1500]) + rng.randn(2) * 0.1).tolist(), i % 3) for i in range(6000)]
    rows = [(i * 3 if i == 10 else i * 3 + 1, v, label) for i, v, label in rows]  # one anchor
    read = []
    given = hn._chosen_blocks
    monkeypatch.setattr(hn, "_chosen_blocks", lambda blocks, names: (read.append((names.count(), blocks.count())), given(blocks, names))[1])
    assert mined(spark, rows) == brute(rows)
    assert all(4 * chosen <= 2 * blocks for chosen, blocks in read) and len(read) == 3


def test_scores_beyond_the_type_are_an_error(spark):
    with pytest.raises(Exception, match="62 bits"):
        mined(spark, [(3, [1e12], 1), (4, [1e12], 1), (5, [1e12], 2)])
