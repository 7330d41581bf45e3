"""Boosted trees against the same algorithm in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablejobs.models import boosting, metrics
from tablejobs.models.boosting import Node, _Round, fit_boosted


def score(g, h, l1, l2):
    t = max(abs(g) - l1, 0.0)
    return t * t / (h + l2) if h + l2 else 0.0


def plain(rows, numbers, rounds, depth, rate, l1, l2, least):
    """Trees as {node: (feature, cut or category, missing_left, gain, hessian, rows, value)}; rows are (features, y)."""
    margins, trees = [0.0] * len(rows), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g, h = [a - y for a, (_, y) in zip(p, rows)], [a * (1 - a) for a in p]
        tree, level = {}, {1: list(range(len(rows)))}
        for d in range(depth + 1):
            below = {}
            for node, own in level.items():
                G, H = sum(g[i] for i in own), sum(h[i] for i in own)
                value = -rate * math.copysign(max(abs(G) - l1, 0), G) / (H + l2) if H + l2 else 0.0
                best = None
                for f in range(len(rows[0][0])) if d < depth else []:
                    known = sorted({rows[i][0][f] for i in own if rows[i][0][f] is not None})
                    for cut in known:
                        for missing in (False, True):
                            left = [i for i in own if (missing if rows[i][0][f] is None else rows[i][0][f] <= cut if f < numbers else rows[i][0][f] == cut)]
                            a, b = sum(g[i] for i in left), sum(h[i] for i in left)
                            gain = score(a, b, l1, l2) + score(G - a, H - b, l1, l2) - score(G, H, l1, l2)
                            if 0 < len(left) < len(own) and gain > 1e-9 and b >= least and H - b >= least:
                                if best is None or round(gain, 9) > round(best[3], 9):
                                    best = (f, cut, missing, gain, left)
                tree[node] = (*(best[:4] if best else (None,) * 4), H, len(own), None if best else value)
                if best:
                    inside = set(best[4])
                    below[2 * node], below[2 * node + 1] = best[4], [i for i in own if i not in inside]
                else:
                    for i in own:
                        margins[i] += value
            level = below
        trees.append(tree)
    return trees


def data(n=400, seed=3):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.choice([None, 1.0, 2.0, 3.0, 4.0, 5.5]), draw.randint(0, 9) * 1.0, draw.choice(["x", "y", "z", None])
        p = 0.15 + 0.5 * (b > 5) + 0.25 * (c == "y") * ((a or 9) > 2)
        rows.append(((a, b, c), int(draw.random() < p)))
    return rows


def frame(spark, rows):
    table = [(i, *x, y) for i, (x, y) in enumerate(rows)]
    return spark.createDataFrame(table, "id long, a double, b double, c string, y int").repartition(5)


@pytest.mark.parametrize("l1,l2,least", [(0.0, 0.0, 0.0), (1.0, 1.0, 0.0), (0.5, 2.0, 8.0)])
def test_trees_are_those_of_plain_boosting(spark, l1, l2, least):
    rows = data()
    options = {"max_iter": 3, "max_depth": 3, "learn_rate": 0.4, "l1": l1, "l2": l2, "min_child_weight": least, "min_rel_progress": 0.0}
    model = fit_boosted(frame(spark, rows), "y", "id", ["a", "b"], ["c"], **options)
    expected = plain(rows, 2, 3, 3, 0.4, l1, l2, least)
    names = ["a", "b", "c"]
    found = {(r["round"], r["node"]): r for r in model.splits_table(spark).collect()}
    assert set(found) == {(k, i) for k, tree in enumerate(expected) for i in tree}
    for (k, i), r in found.items():
        f, cut, missing, gain, cover, n, value = expected[k][i]
        assert r["feature"] == (None if f is None else names[f]) and r["rows"] == n and r["cover"] == pytest.approx(cover)
        if f is None:
            assert r["value"] == pytest.approx(value, abs=1e-9)
        else:
            assert (r["cut"] if f < 2 else r["category"]) == cut and r["gain"] == pytest.approx(gain)
            if any(x[f] is None for x, _ in rows):
                assert r["missing_left"] == missing


def test_importance_adds_up_the_splits(spark):
    model = fit_boosted(frame(spark, data()), "y", "id", ["a", "b"], ["c"], max_iter=4, max_depth=3, l2=1.0)
    splits = [r for r in model.splits_table(spark).collect() if r["feature"]]
    for r in model.importance_table(spark).collect():
        own = [s for s in splits if s["feature"] == r["feature"]]
        assert r["importance_weight"] == len(own)
        assert r["importance_gain"] == pytest.approx(sum(s["gain"] for s in own) / max(len(own), 1))
        assert r["importance_cover"] == pytest.approx(sum(s["cover"] for s in own) / max(len(own), 1))


def test_penalties_and_child_weight_bite(spark):
    df = frame(spark, data())

    def fit(**options):
        return fit_boosted(df, "y", "id", ["a", "b"], ["c"], max_iter=2, max_depth=4, **options)

    def leaves(model):
        return [n for r in model.trees for t in r for n in t.values() if n.feature is None]

    free, heavy = leaves(fit()), leaves(fit(min_child_weight=20.0))
    assert min(n.hessian for n in free) < 20 <= min(n.hessian for n in heavy) and len(heavy) < len(free)
    assert max(abs(n.value) for n in leaves(fit(l2=50.0))) < max(abs(n.value) for n in free)
    assert all(n.value == 0 for n in leaves(fit(l1=1e6)))


def test_scores_margins_written_between_and_early_stop(spark):
    rows = data(600)
    df = frame(spark, rows).withColumn("stops", F.col("id") % 5 == 0)
    model = fit_boosted(df, "y", "id", ["a", "b"], ["c"], max_iter=13, max_depth=2, learn_rate=0.3, l2=1.0, min_rel_progress=0.0)
    expected = plain(rows, 2, 13, 2, 0.3, 0.0, 1.0, 0.0)
    assert [{i: n.rows for i, n in r[0].items()} for r in model.trees] == [{i: n[5] for i, n in t.items()} for t in expected]
    scored = model.transform(df)
    assert scored.columns == [*df.columns, "score"]
    assert metrics.evaluate_classification(scored, "y", "score").first()["roc_auc"] > 0.75
    stopped = fit_boosted(df, "y", "id", ["a", "b"], ["c"], max_iter=60, max_depth=3, learn_rate=0.5, stops="stops")
    assert len(stopped.trees) < 60 and stopped.losses[-2] - stopped.losses[-1] < 0.01 * stopped.losses[-2]
    assert sum(n.rows for i, n in stopped.trees[0][0].items() if i == 1) == 480


def test_samples_parallel_trees_and_hashed_columns(spark):
    df = frame(spark, data(600))
    options = {"numeric": ["a", "b"], "categorical": ["c"], "hashed": ["c"], "max_iter": 1, "max_depth": 3, "trees_per_round": 8, "learn_rate": 1.0}
    model = fit_boosted(df, "y", "id", subsample=0.67, columns_per_node=0.67, **options)
    again = fit_boosted(df.repartition(3), "y", "id", subsample=0.67, columns_per_node=0.67, **options)
    rows = [t[1].rows for t in model.trees[0]]
    assert len(set(rows)) > 1 and all(330 < n < 470 for n in rows)
    assert [sorted(t) for t in model.trees[0]] == [sorted(t) for t in again.trees[0]]
    assert metrics.evaluate_classification(model.transform(df), "y", "score").first()["roc_auc"] > 0.7


def test_odd_tables(spark):
    df = frame(spark, data(50))
    assert fit_boosted(df.limit(0), "y", "id", ["a"], ["c"]).trees == []
    blank = fit_boosted(df.withColumn("a", F.lit(None).cast("double")), "y", "id", ["a"], max_iter=1)
    assert set(blank.trees[0][0]) == {1} and isinstance(blank.trees[0][0][1], Node)
    unseen = df.limit(3).withColumn("c", F.lit("never")).withColumn("a", F.lit(float("nan")))
    model = fit_boosted(df.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), "y", "id", ["a"], ["c"], max_iter=2)
    assert model.trees[0][0][1].rows == 44 and model.transform(unseen).filter("score is null").count() == 0


def test_columns_with_many_categories(spark):
    n = 30_000  # a list of literals for each category, and a count for each in every node, took minutes
    df = spark.range(2 * n).selectExpr("id", "concat('k', id % 30000) as many", "cast(id % 7 as string) as few", "cast(id % 30000 < 3 or id % 7 = 2 as int) as y")
    model = fit_boosted(df, "y", "id", categorical=["many", "few"], max_iter=2, max_depth=2, learn_rate=1.0)
    assert model.categories.count() == n + 7
    first = model.trees[0][0]
    assert (model.features[first[1].feature], first[1].bin, first[2].rows + first[3].rows) == ("few", 3, 2 * n)
    names = {r["category"] for r in model.splits_table(spark).filter("feature = 'many'").collect()}
    assert names and names <= {"k0", "k1", "k2"}
    scored = {r["id"]: r["score"] for r in model.transform(df.filter("id < 12")).collect()}
    assert scored[2] > 0.8 and scored[9] > 0.8 and scored[11] < 0.5


def test_partitions_follow_the_sums(spark, monkeypatch):
    df, parts, cut = frame(spark, data()), [], boosting.best_cuts

    def counted(sums, *args):
        parts.append(sums.rdd.getNumPartitions())
        return cut(sums, *args)

    monkeypatch.setattr(boosting, "best_cuts", counted)
    options = {"numeric": ["a", "b"], "categorical": ["c"], "max_iter": 2, "max_depth": 3, "l2": 1.0, "min_rel_progress": 0.0}
    few = fit_boosted(df, "y", "id", **options).trees
    assert len(parts) > 4 and set(parts) == {1}  # some hundred sums; were as many as the session's shuffle partitions
    parts.clear()
    monkeypatch.setattr(boosting, "SUMS_PER_TASK", 8)
    many = fit_boosted(df, "y", "id", **options).trees
    assert 1 < max(parts) <= 8
    shape = lambda trees: [{i: (n.feature, n.bin, n.missing_left, n.rows) for i, n in t.items()} for r in trees for t in r]
    assert shape(few) == shape(many)


def test_partitions_of_many_sums():
    now = _Round([], [{2: Node(0, 0, 1000, 0), 3: Node(0, 0, 10**9, 0)}], [[2, 3]], 0, 1.0, 0, features=3, width=10**7)
    assert now.partitions([[2]], 100, 200) == 1  # no more than one sum for each row and feature
    assert now.partitions([[3]], 100, 10**6) == 1 + 100 * (10**7 + 1) // boosting.SUMS_PER_TASK
    assert now.partitions([[2, 3]], 100, 200) == 200 and now.partitions([[]], 100, 200) == 1
    assert now.partitions([[1]], 1, 200) == 1 + (10**7 + 1) // boosting.SUMS_PER_TASK  # a root
