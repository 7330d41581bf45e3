"""Every registered query against its SQL, and its plan against joins that do not scale."""

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def ordered(columns, found):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in places) for r in found], key=repr)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.columns == ["department", "product_name", "nb_commandes", "rk"]
    assert result.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, db, plan, key):
    result = QUERIES[key](spark, SF)
    text = plan(result)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    expected = db.execute(ORACLES[key])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(result.columns)
    assert ordered(result.columns, result.collect()) == ordered(names, expected.fetchall())


# Rows of the queries without SQL, null where the number depends on the fit.
WITHOUT_SQL = {
    "limit_any": None,
    "linreg_elastic": 1,
    "linreg_gd": 1,
    "model_weights": None,
    "trip_duration_model": 5,
    "logreg_fit": 1,
    "boosted_trees_fit": 1,
    "forest_fit": 1,
    "trip_type_model": 4,
    "logreg_class_weights": 2,
    "feature_importance": None,
    "kmeans_fit_select": 3,
    "kmeans_default": None,
    "segmentation_run": None,
}


@pytest.mark.parametrize("key", sorted(WITHOUT_SQL))
def test_has_rows(spark, key):
    found = QUERIES[key](spark, SF).count()
    assert found == WITHOUT_SQL[key] if WITHOUT_SQL[key] else found > 0


def test_scoring_run_is_whole(spark):
    found = QUERIES["scoring_run"](spark, SF).collect()
    models = ["boosted", "constant_rate", "logistic", "logistic_penalised"]
    for part, item in (("all", "confusion"), ("held_out", "confusion"), ("all", "roc_recall")):
        assert sorted({r.model for r in found if r.part == part and r.item == item}) == models
    learnt = {m: {r["at"]: r.value for r in found if r.model == m and r.item == ("importance_gain" if m == "boosted" else "weight")} for m in models}
    inputs = set(learnt["boosted"])
    assert inputs and not inputs & {"stops", "is_eval", "class_weight", "cible", "user_id"}
    assert all(set(learnt[m]) == inputs | {"__INTERCEPT__"} for m in models[1:])
    assert 0 < sum(w == 0 for w in learnt["logistic_penalised"].values())  # the lasso leaves inputs out
