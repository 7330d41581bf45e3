"""Segments of several k fitted together, against plain k-means over all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs.models import clustering, metrics


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(11)
    found = [(draw.choice([1, 2, 3, 4]), draw.choice([1.0, 2.0, 4.0, 8.0, None]), draw.randrange(3)) for _ in range(900)]
    return found, spark.createDataFrame(found, "a int, b double, c int").repartition(5).persist()


FEATURES = ["a", "b", "c"]


def scaled(found):
    x = np.array([[np.nan if v is None else v for v in r] for r in found], float)
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    return (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)


def test_centroids_are_means_of_their_rows_and_the_index_is_that_of_the_assignment(data):
    found, df = data
    z = scaled(found)
    for s in clustering.fit_all(df, FEATURES, [2, 5]):
        centers = np.array(s.centroids)
        near = ((z[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        means = np.array([z[near == i].mean(axis=0) for i in range(len(centers))])
        assert np.abs(means - centers).max() < 1e-3  # no pass would move them
        assigned = s.assign(df)
        sizes = {r.centroid_id: r["count"] for r in assigned.groupBy("centroid_id").count().collect()}
        assert sizes == {i + 1: int((near == i).sum()) for i in range(len(centers))}
        expected = metrics.davies_bouldin(assigned, s.centroids).first()["davies_bouldin_index"]
        assert s.davies_bouldin_index == pytest.approx(expected)
        profile = {r.centroid_id: r.a for r in metrics.segment_profile(assigned, ["a"]).collect()}
        assert profile == pytest.approx({i + 1: np.mean([r[0] for r, at in zip(found, near) if at == i]) for i in range(len(centers))})


def test_passes_do_not_depend_on_how_many_are_tried(data, monkeypatch):
    _, df = data
    plain, passes = clustering._pass, []
    monkeypatch.setattr(clustering, "_pass", lambda rows, tried: passes.append(sorted(tried)) or plain(rows, tried))
    alone = {}
    for k in (3, 4, 5):
        passes.clear()
        alone[k] = (clustering.fit_segments(df, FEATURES, k), len(passes))
    passes.clear()
    together = clustering.fit_all(df, FEATURES, [3, 4, 5])
    assert len(passes) == max(n for _, n in alone.values()) and passes[0] == [3, 4, 5]
    assert all(np.allclose(t.centroids, alone[k][0].centroids) for k, t in zip((3, 4, 5), together))


def test_partitions_and_repeated_rows_change_nothing(data):
    _, df = data
    one = clustering.fit_segments(df.repartition(1), FEATURES, 4)
    two = clustering.fit_segments(df.repartition(17), FEATURES, 4)
    assert np.allclose(one.centroids, two.centroids)


def test_fewer_rows_than_segments_constants_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 7), (1.0, 7), (2.0, 7)], "a double, b int")
    found = clustering.fit_segments(df, ["a", "b"], 5)
    assert len(found.centroids) == 2
    assert sorted(r["count"] for r in found.assign(df).groupBy("centroid_id").count().collect()) == [1, 2]
    assert clustering.fit_segments(df.limit(1), ["a"], 3).davies_bouldin_index is None
    assert clustering.fit_segments(df.select("a", F.lit(None).cast("double").alias("n")), ["a", "n"], 2).assign(df.withColumn("n", F.lit(None).cast("double"))).count() == 3
    with pytest.raises(ValueError):
        clustering.fit_segments(df.limit(0), ["a"], 2)
