"""Subgradients of fitted weights against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs.models import training
from tablejobs.models.optimality import residuals


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(5)
    found = []
    for _ in range(300):
        x, c = draw.gauss(3, 2), draw.choice("abc")
        y = 2 * x + 4 * (c == "a") + draw.gauss(0, 1)
        found.append((x, c, y, int(y > 7)))
    return found, spark.createDataFrame(found, "x double, c string, y double, label int").repartition(3).persist()


def all_of(df):
    return {(r.processed_input, r.category): r for r in df.collect()}


def test_squared_loss_at_and_off_the_optimum(data):
    found, df = data
    model = training.fit(df, "y", training.linear(0.3, 0.2).setTol(1e-10), ["c"], ["x"])
    got = all_of(residuals(model, df, "y", ["c"], ["x"], l1=0.3, l2=0.2))
    assert set(got) == {("x", None), ("c", "a"), ("c", "b"), ("c", "c"), ("__INTERCEPT__", None)}
    assert max(r.residual for r in got.values()) < 1e-4
    # The same weights under other penalties: off by what numpy says.
    off = all_of(residuals(model, df, "y", ["c"], ["x"], l1=0.0, l2=0.7))
    x, y = np.array([r[0] for r in found]), np.array([r[2] for r in found])
    weight = {k: r.weight for k, r in got.items()}
    guess = weight["__INTERCEPT__", None] + weight["x", None] * x + np.array([weight["c", r[1]] for r in found])
    for key, column in {("x", None): x, ("c", "a"): np.array([r[1] == "a" for r in found], float)}.items():
        slope = ((guess - y) * column).mean()
        assert off[key].slope == pytest.approx(slope)
        assert off[key].residual == pytest.approx(abs(slope + 0.7 * column.var() * weight[key] / y.std()))
    assert off["x", None].residual > 0.01 and off["c", "a"].n == sum(r[1] == "a" for r in found)


def test_class_weights_change_the_optimum(data):
    _, df = data
    weight = training.class_weight("label", {1: 0.9, 0: 0.1})
    plain, weighted = (training.fit(df, "label", training.logistic(0.01, 0.01).setTol(1e-10), ["c"], ["x"], weight=w) for w in (None, weight))
    options = {"loss": "log", "l1": 0.01, "l2": 0.01}

    def worst(model, w):
        return max(r.residual for r in residuals(model, df, "label", ["c"], ["x"], weight=w, **options).collect())

    assert worst(plain, None) < 1e-4 and worst(weighted, weight) < 1e-4
    assert worst(plain, weight) > 0.01 and worst(weighted, None) > 0.01


def test_nulls_and_no_rows(spark, data):
    _, df = data
    holes = df.union(spark.createDataFrame([(None, None, 1.0, 1), (1.0, "a", None, None)], df.schema))
    model = training.fit(df, "y", training.linear(), ["c"], ["x"])
    got = all_of(residuals(model, holes, "y", ["c"], ["x"]))
    assert got["__INTERCEPT__", None].n == 301 and got["c", "__unseen"].n == 1 and got["c", "a"].n == df.filter("c = 'a'").count()
    assert residuals(model, df.limit(0), "y", ["c"], ["x"]).count() == 0
    with pytest.raises(ValueError):
        residuals(model, df, "y", loss="hinge")
