"""Trees over categories against MLlib's on one-hot columns, where nothing is drawn."""

import random

import pytest
from pyspark.sql import functions as F

from tablejobs.models import training
from tablejobs.models.category_trees import fit_boosting, fit_forest


@pytest.fixture(scope="module")
def frame(spark):
    draw = random.Random(8)
    rows = []
    for i in range(900):
        a, b = draw.choice(["p", "q", "r", "s", None]), draw.choice("uvwxyz")
        p = 0.1 + 0.6 * (a == "q") + 0.2 * (b in "vz") - 0.08 * (a is None)
        rows.append((i, a, b, int(draw.random() < p), i % 5 == 0))
    return spark.createDataFrame(rows, "id long, a string, b string, y int, stops boolean").repartition(3).persist()


def scores(df):
    return {r["id"]: r["score"] for r in df.collect()}


def test_forest_is_that_of_mllib(spark, frame):
    plain = training.forest(trees=1, subsample=1.0, max_depth=4, min_rows=20).setBootstrap(False).setFeatureSubsetStrategy("all")
    expected = scores(training.score(training.fit(frame, "y", plain, categorical=["a", "b"], extra=["id"]), frame))
    found = scores(fit_forest(frame, "y", "id", ["a", "b"], 1, 1.0, 4, 20, bootstrap=False, all_slots=True).transform(frame))
    assert found == pytest.approx(expected) and len(set(expected.values())) > 1


def test_boosting_is_that_of_mllib(spark, frame):
    plain = training.boosted_trees(max_iter=12, subsample=1.0, max_depth=3, min_rows=20, validation="stops")
    model = training.fit(frame, "y", plain, categorical=["a", "b"], extra=["id", "stops"])
    found = fit_boosting(frame, "y", "id", ["a", "b"], "stops", 12, subsample=1.0, max_depth=3, min_rows=20)
    assert len(found.trees) == len(model.stages[-1].trees)
    assert scores(found.transform(frame)) == pytest.approx(scores(training.score(model, frame)))


def test_draws_and_many_categories(spark, frame):
    n = 20_000  # one-hot rows of all of these were 20,000 numbers wide
    df = frame.join(spark.range(50).withColumnRenamed("id", "k"), how="cross").withColumn("id", F.col("id") * 50 + F.col("k"))
    df = df.withColumn("many", F.concat(F.lit("m"), F.col("id") % n))
    model = fit_forest(df, "y", "id", ["a", "b", "many"], trees=5, max_depth=2)
    rows = [t[1].rows for t in model.trees]
    assert model.counts == [4, 6, n] and len(set(rows)) > 1 and all(abs(r - 0.67 * 45_000) < 1_000 for r in rows)
    assert all(abs(s - 0.3) < 0.3 for s in scores(model.transform(df.filter("id < 100"))).values())
