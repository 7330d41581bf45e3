"""Running sums over ranges against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from tablejobs.models import metrics
from tablejobs.operators import prefix_sums


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", [1, 7, 50])
def test_running_sums_by_group(spark, descending, parts):
    draw = random.Random(parts)
    data = [(draw.choice(["hot", "hot", "hot", "x", None]), i, draw.choice([1, 2, 5, None]), draw.random()) for i in range(400)]
    data.append(("x", None, 3, 0.5))
    df = spark.createDataFrame(data, "k string, at int, v int, w double").repartition(5)
    found = prefix_sums(df, ["at"], {"vs": "v", "ws": "w"}, by=["k"], descending=descending, parts=parts)
    assert found.columns == ["k", "at", "v", "w", "vs", "ws"]
    rows, expected, sums = found.collect(), {}, {}
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0), reverse=descending)
    for k, at, v, w in order:
        a, b = sums.get(k, (0, 0.0))
        sums[k] = (a + (v or 0), b + w)
        expected[k, at] = sums[k]
    assert len(rows) == len(data)
    for r in rows:
        assert (r["vs"], r["ws"]) == (expected[r["k"], r["at"]][0], pytest.approx(expected[r["k"], r["at"]][1]))


def test_equal_rows_count_up_and_no_rows_stay_none(spark):
    df = spark.range(300).select(F.lit(1).alias("at"), F.lit(1).alias("one"))
    found = prefix_sums(df, ["at"], {"n": "one"}, parts=6)
    assert sorted(r["n"] for r in found.collect()) == list(range(1, 301))
    assert prefix_sums(df.limit(0), ["at"], {"n": "one"}).count() == 0


def test_no_task_holds_all_rows(spark, plan):
    df = spark.range(1000).withColumn("one", F.lit(1))
    text = plan(prefix_sums(df, ["id"], {"n": "one"}, parts=9))
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert len(windows) == 2 and sum("windowspecdefinition(__part#" in line and "sum(one#" in line for line in windows) == 1  # the other one sees a row for each range
    assert text.count("Exchange SinglePartition") == 1


def test_roc_at_every_score(spark):
    draw = random.Random(8)
    data = [(draw.randint(0, 1), draw.choice([draw.random(), 0.5, 0.25, None])) for _ in range(500)] + [(None, 0.3)]
    df = spark.createDataFrame(data, "y int, s double")
    found = {r["threshold"]: r for r in metrics.roc_curve(df, "y", "s", bins=None).collect()}
    scored = [(y, s) for y, s in data if s is not None]
    assert set(found) == {s for _, s in scored}
    pos, neg = sum(y == 1 for y, _ in scored), sum(y == 0 for y, _ in scored)
    for t, r in found.items():
        tp, fp = sum(y == 1 and s >= t for y, s in scored), sum(y == 0 and s >= t for y, s in scored)
        assert (r["true_positives"], r["false_positives"], r["true_negatives"], r["false_negatives"]) == (tp, fp, neg - fp, pos - tp)
        assert r["recall"] == pytest.approx(tp / pos) and r["false_positive_rate"] == pytest.approx(fp / neg)
