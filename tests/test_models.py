"""Metrics against brute force; fits by what they must achieve."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tablejobs.models import clustering, metrics, tables, training
from tablejobs.models import descent
from tablejobs.models.descent import fit_descent
from tablejobs.models.features import TripFeatures, trip_columns
from tablejobs.session import work_dir


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(3)
    data = []
    for _ in range(400):
        p = round(draw.random(), 2)  # few distinct scores, so ties matter
        data.append((1 if draw.random() < p else 0, p))
    return data, spark.createDataFrame(data, "label int, score double").persist()


def test_classification_metrics(scored):
    data, df = scored
    found = metrics.evaluate_classification(df, "label", "score", 0.4).first()
    tp = sum(1 for y, p in data if y and p >= 0.4)
    fp = sum(1 for y, p in data if not y and p >= 0.4)
    fn = sum(1 for y, p in data if y and p < 0.4)
    pairs = [(a > b) + 0.5 * (a == b) for y, a in data if y for z, b in data if not z]
    safe = [min(max(p, 1e-15), 1 - 1e-15) for _, p in data]
    loss = -sum(math.log(s if y else 1 - s) for (y, _), s in zip(data, safe)) / len(data)
    assert found["precision"] == pytest.approx(tp / (tp + fp))
    assert found["recall"] == pytest.approx(tp / (tp + fn))
    assert found["accuracy"] == pytest.approx((len(data) - fp - fn) / len(data))
    assert found["f1_score"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert found["roc_auc"] == pytest.approx(sum(pairs) / len(pairs))
    assert found["log_loss"] == pytest.approx(loss)


def test_no_positive_prediction_gives_null_precision(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")
    found = metrics.evaluate_classification(df, "label", "score", 0.9).first()
    assert found["precision"] is None and found["recall"] == 0.0


def test_confusion_and_roc(scored):
    data, df = scored
    matrix = rows(metrics.confusion_matrix(df, "label", "score", 0.4))
    assert matrix[1][2] == sum(1 for y, p in data if y and p >= 0.4)
    assert sum(r[1] + r[2] for r in matrix) == len(data)
    curve = metrics.roc_curve(df, "label", "score", 10).orderBy("threshold").collect()
    for r in curve:
        assert r["true_positives"] == sum(1 for y, p in data if y and math.floor(p * 10) >= round(r["threshold"] * 10))
        assert r["true_positives"] + r["false_negatives"] == sum(y for y, _ in data)
    assert curve[0]["recall"] == 1.0 and curve[0]["false_positive_rate"] == 1.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 1.0), (9.0, 9.5)], "y double, p double")
    found = metrics.evaluate_regression(df, "y", "p").first()
    assert tuple(found) == pytest.approx((4.5 / 4, 0.75, (1 + 9 + 0.25) / 4, 1 - (10.25 / 4) / 9.5))


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert rows(metrics.class_balance(df, "y")) == [(0, 3, 0.75), (1, 1, 0.25)]


def test_standardize_constant_and_null(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "id int, a double, b double")
    found = rows(metrics.standardize(df, ["a", "b"]))
    assert found[0][1] == pytest.approx(-math.sqrt(0.5)) and found[2][1] is None
    assert {r[2] for r in found} == {0.0}


def test_clusters_against_brute_force(spark):
    draw = random.Random(5)
    points = [(draw.uniform(0, 10), draw.uniform(0, 10)) for _ in range(200)]
    centers = [[2.0, 2.0], [8.0, 3.0], [5.0, 9.0]]
    df = spark.createDataFrame(points, "x double, y double")
    assigned = metrics.assign_clusters(df, ["x", "y"], centers)
    mean = {}
    for x, y, c, d in [tuple(r) for r in assigned.collect()]:
        gaps = [math.dist((x, y), p) for p in centers]
        assert d == pytest.approx(min(gaps)) and c == gaps.index(min(gaps)) + 1
        mean.setdefault(c, []).append(d)
    s = {c: sum(v) / len(v) for c, v in mean.items()}
    worst = [
        max((s[i] + s[j]) / math.dist(centers[i - 1], centers[j - 1]) for j in s if j != i) for i in s
    ]
    found = metrics.davies_bouldin(assigned, centers).first()
    assert found["davies_bouldin_index"] == pytest.approx(sum(worst) / len(worst))
    profile = rows(metrics.segment_profile(assigned, ["x"]))
    assert [r[0] for r in profile] == [1, 2, 3]


def test_selection_finds_planted_clusters(spark):
    draw = random.Random(1)
    data = [(i, draw.gauss(10 * (i % 3), 0.5), draw.gauss(-7 * (i % 3), 0.5)) for i in range(300)]
    df = spark.createDataFrame(data, "id int, a double, b double")
    best, tried = clustering.select_segments(df, ["a", "b"])
    assert [len(s.centroids) for s in tried] == [3, 4, 5] and len(best.centroids) == 3
    sizes = rows(best.assign(df).groupBy("centroid_id").count())
    assert [r[1] for r in sizes] == [100, 100, 100]


@pytest.fixture(scope="module")
def trips(spark):
    draw = random.Random(9)
    data = []
    for i in range(600):
        station, hour = draw.choice("ABC"), draw.randrange(24)
        duration = {"A": 10.0, "B": 20.0, "C": 60.0}[station] + 0.5 * hour + draw.gauss(0, 1)
        data.append((i, station, duration, f"2024-01-{1 + i % 28:02d} {hour:02d}:00:00"))
    df = spark.createDataFrame(data, "hire_id int, start_station_name string, duration double, d string")
    return df.withColumn("start_date", F.to_timestamp("d")).drop("d").persist()


def fit_duration(trips, estimator, version="plain"):
    return training.fit(trips, "duration", estimator, categorical=list(trip_columns(version)), prepare=TripFeatures(version))


def test_linear_model_replays_its_features_on_unseen_rows(spark, trips):
    model = fit_duration(trips, training.linear())
    error = metrics.evaluate_regression(training.predict(model, trips), "duration", "prediction").first()
    assert error["r2_score"] > 0.95
    raw = trips.limit(1).withColumn("start_station_name", F.lit("never seen"))
    assert training.predict(model, raw).count() == 1


def test_saved_model_keeps_its_feature_stage(spark, trips):
    model = fit_duration(trips, training.linear(), "bucketized")
    path = work_dir(spark, "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].getOrDefault("version") == "bucketized"
    assert rows(training.predict(again, trips.limit(20))) == rows(training.predict(model, trips.limit(20)))


def test_weights_table_reproduces_the_prediction(spark, trips):
    model = fit_duration(trips, training.linear(0.1, 0.1))
    weights = tables.weights_table(spark, model)
    per_category = {(r[0], r[1]): r[2] for r in tables.category_weights(weights).collect()}
    intercept = weights.filter("processed_input = '__INTERCEPT__'").first()["weight"]
    row = TripFeatures("plain").transform(trips).limit(1).first()
    total = intercept + sum(per_category[(c, row[c])] for c in ("station", "dayofweek", "hourofday"))
    predicted = training.predict(model, trips.filter(F.col("hire_id") == row["hire_id"])).first()["prediction"]
    assert total == pytest.approx(predicted)


def test_grouped_rows_give_the_same_classifier(spark, trips):
    rows_ = trips.withColumn("is_long", (F.col("duration") > 30).cast("int"))
    fits = [
        training.fit(rows_, "is_long", training.logistic(0.01, 0.01, standardize=False), categorical=["station", "dayofweek", "hourofday"], prepare=TripFeatures("plain"), count_rows=c)
        for c in (False, True)
    ]
    a, b = [m.stages[-1].coefficients.toArray() for m in fits]
    assert a == pytest.approx(b, abs=2e-3)
    quality = metrics.evaluate_classification(training.score(fits[1], rows_), "is_long", "score").first()
    assert quality["roc_auc"] > 0.9


def test_descent_falls_and_its_penalty_clears_weights(spark, trips):
    rows_ = TripFeatures("plain").transform(trips)
    cats = ["station", "dayofweek", "hourofday"]
    kept = []
    for l1 in (0.0, 1.0, 5.0):
        model = fit_descent(rows_, "duration", cats, learn_rate=0.5, max_iter=15, l1=l1, min_rel_progress=1e-6)
        assert all(b <= a + 1e-9 for a, b in zip(model.history, model.history[1:]))
        weights = tables.category_weights(model.weights_table(spark))
        kept.append(weights.filter("weight <> 0").count())
    assert kept[0] > kept[1] > kept[2]
    free = fit_descent(rows_, "duration", cats, learn_rate=0.5, max_iter=25, min_rel_progress=1e-6)
    error = metrics.evaluate_regression(free.transform(rows_), "duration", "prediction").first()
    assert error["r2_score"] > 0.9
    unseen = rows_.limit(1).withColumn("station", F.lit("never seen"))
    assert free.transform(unseen).first()["prediction"] is not None


def test_descent_with_numbers_and_log_loss(spark):
    draw = random.Random(2)
    data = []
    for i in range(500):
        x, noise = draw.gauss(100, 20), draw.gauss(0, 5)
        data.append((x if i % 50 else None, noise, 1 if x + noise > 100 else 0))
    df = spark.createDataFrame(data, "x double, z double, y int")
    model = fit_descent(df, "y", numeric=["x", "z"], loss="log", learn_rate=0.5, max_iter=40, min_rel_progress=1e-4)
    quality = metrics.evaluate_classification(model.transform(df, "score"), "y", "score").first()
    assert quality["roc_auc"] > 0.95 and model.history[-1] < model.history[0]


def test_descent_steps_as_numpy_does(spark):
    draw = np.random.default_rng(6)
    station, x = draw.integers(0, 3, 200), draw.normal(5, 2, 200)
    y = 3.0 * station + 0.7 * x + draw.normal(0, 0.1, 200)
    df = spark.createDataFrame([(str(s), float(a), float(b)) for s, a, b in zip(station, x, y)], "s string, x double, y double")
    model = fit_descent(df, "y", ["s"], ["x"], learn_rate=0.1, max_iter=7, l1=0.05, l2=0.02, min_rel_progress=0.0)
    matrix = np.column_stack([station == 0, station == 1, station == 2, (x - x.mean()) / x.std()]).astype(float)
    weights, intercept, losses = np.zeros(4), y.mean(), []
    for _ in range(7):
        residual = matrix @ weights + intercept - y
        losses.append((residual**2).mean() / 2)
        gradient = matrix.T @ residual / 200
        intercept -= 0.1 * residual.mean()
        moved = weights - 0.1 * (gradient + 0.02 * weights)
        weights = np.sign(moved) * np.maximum(np.abs(moved) - 0.1 * 0.05, 0)
    assert model.history == pytest.approx(losses)
    assert [r["weight"] for r in model.categories.orderBy("category").collect()] == pytest.approx(weights[:3])
    assert model.numbers["x"] == pytest.approx(weights[3] / x.std())
    found = [r["prediction"] for r in model.transform(df).orderBy("x").collect()]
    assert found == pytest.approx((matrix @ weights + intercept)[np.argsort(x)])


def test_early_stop(spark, trips):
    rows_ = TripFeatures("plain").transform(trips)
    model = fit_descent(rows_, "duration", ["station"], max_iter=50, min_rel_progress=0.5)
    assert len(model.history) == 2


def test_class_weight(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "y int")
    assert [r[0] for r in df.select(training.class_weight("y", {0: 0.2, 1: 0.8})).collect()] == [0.2, 0.8, 1.0]


def test_trees_rank_the_deciding_column_first(spark):
    draw = random.Random(4)
    data = [(draw.random(), draw.random()) for _ in range(800)]
    df = spark.createDataFrame([(a, b, 1 if a > 0.6 else 0, i % 5 == 0) for i, (a, b) in enumerate(data)], "a double, b double, y int, stops boolean")
    boosted = training.fit(df, "y", training.boosted_trees(max_iter=5, max_depth=2, validation="stops"), numeric=["a", "b"], extra=["stops"])
    forest = training.fit(df, "y", training.forest(trees=10, max_depth=3), numeric=["a", "b"])
    for model in (boosted, forest):
        assert tables.importance_table(spark, model).first()["feature"] == "a"
        assert metrics.evaluate_classification(training.score(model, df), "y", "score").first()["roc_auc"] > 0.95


def test_named_categories_are_hashed(spark):
    df = spark.createDataFrame([(str(i % 10), "a" if i % 2 else "b", float(i % 10)) for i in range(200)], "many string, few string, y double")
    model = training.fit(df, "y", training.linear(l2=1e-6), categorical=["many", "few"], hashed=["many"])
    error = metrics.evaluate_regression(training.predict(model, df), "y", "prediction").first()
    assert error["r2_score"] > 0.99
    with pytest.raises(ValueError, match="other"):
        training.fit(df, "y", training.linear(), categorical=["few"], hashed=["other"])


def test_descent_takes_any_number_of_categories(spark, monkeypatch):
    """A million categories, joined by shuffle, beside a column of few, broadcast; steps as in numpy."""
    monkeypatch.setattr(descent, "BROADCAST_BYTES", 10_000)
    n = 1_000_000
    df = spark.range(n).selectExpr("concat('k', id) as many", "string(id % 3) as few", "double(id % 5) as y")
    model = fit_descent(df, "y", ["many", "few"], learn_rate=0.5, max_iter=3, l2=0.01, min_rel_progress=0.0)
    assert model.small == [False, True] and model.categories.filter("processed_input = 'many'").count() == n
    i = np.arange(n)
    y, many, groups, intercept = (i % 5).astype(float), np.zeros(n), np.zeros(3), 2.0
    for _ in range(3):
        r = intercept + many + groups[i % 3] - y
        intercept -= 0.5 * r.mean()
        many = many - 0.5 * (r / n + 0.01 * many)
        groups = groups - 0.5 * (np.bincount(i % 3, weights=r) / n + 0.01 * groups)
    found = {(r["processed_input"], r["category"]): r["weight"] for r in model.categories.filter("processed_input = 'few' or category in ('k7', 'k999999')").collect()}
    assert [found["few", str(k)] for k in range(3)] == pytest.approx(groups.tolist(), abs=1e-12)
    assert [found["many", f"k{k}"] for k in (7, 999_999)] == pytest.approx([many[7], many[999_999]])
    assert model.transform(df.filter("many = 'k0'")).first()["prediction"] == pytest.approx(intercept + many[0] + groups[0])


def test_regression_metrics_leave_out_rows_without_prediction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (1000.0, None)], "y double, p double")
    assert metrics.evaluate_regression(df, "y", "p").first()["r2_score"] == 0.0


def test_descent_without_labels_null_categories_and_rising_loss(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", None), (None, 5.0), (None, 5.0), ("a", 10.0)], "c string, y double")
    model = fit_descent(df, "y", ["c"], learn_rate=1.0, max_iter=60, min_rel_progress=0.0)
    found = {r["c"]: round(r["prediction"], 2) for r in model.transform(df).collect()}
    assert found == {"a": 10.0, None: 5.0}
    with pytest.raises(ValueError, match="learn rate"):
        fit_descent(spark.range(50).selectExpr("id", "3.0 * id as y"), "y", [], ["id"], learn_rate=5.0)


def test_clusters_take_missing_numbers_as_the_mean(spark):
    df = spark.createDataFrame([(0.0, 1.0), (None, 1.1), (10.0, 9.0), (10.1, None)], "a double, b double")
    fitted = clustering.fit_segments(df, ["a", "b"], 2)
    assert fitted.assign(df).count() == 4
