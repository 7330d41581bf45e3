"""Operators on hand-made rows."""

import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablejobs.operators import (
    anti_in,
    cond_count_distinct,
    exact_quantiles,
    flag_by_category,
    flatten,
    hash_fraction,
    hash_sample,
    hash_split,
    join_null_safe,
    lines_json,
    lookup_constants,
    nest_lines,
    partition_sum,
    pivot_agg,
    quartile_classes,
    quartiles,
    ratio_to_subtotal,
    semi_in,
    star_except,
    star_join,
    sum_after_last,
    top_k_per_group,
    top_names,
    two_level_mean,
)


def test_semi_and_anti_treat_repeats_and_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(semi_in(left, right, "k")) == [(1,)]
    assert rows(anti_in(left, right, "k")) == [(2,), (None,)]


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert rows(join_null_safe(left, right, ["k"])) == [("a", 2, 20), (None, 1, 10)]


def test_star_except_names_the_missing_column(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert star_except(df, "b").columns == ["a"]
    with pytest.raises(ValueError, match="c"):
        star_except(df, "c")


def test_star_join_keeps_one_key_and_all_rows(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    parts = [spark.createDataFrame([(1, 5)], "k int, x int"), spark.createDataFrame([(2, 6)], "k int, y int")]
    assert rows(star_join(base, parts, "k")) == [(1, 5, None), (2, None, 6)]


def test_lookup_constants(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    lookup = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "name string, v double")
    found = lookup_constants(df, lookup, "name", "v", {"va": "a", "vb": "b", "vc": "c"})
    assert rows(found) == [(1, 1.5, 2.5, None), (2, 1.5, 2.5, None)]


def test_sum_after_last(spark):
    data = [("u", 1, True, 5.0), ("u", 2, True, None), ("u", 3, False, 7.0), ("u", 4, False, 9.0), ("v", 1, True, 1.0), ("w", 1, False, 1.0)]
    df = spark.createDataFrame(data, "k string, o int, e boolean, v double")
    assert rows(sum_after_last(df, "k", "o", F.col("e"), "v", "s")) == [("u", 16.0)]


def test_cond_count_distinct_counts_orders_not_lines(spark):
    data = [(1, 10, "a"), (1, 10, "a"), (1, 11, "a"), (1, 11, "b"), (1, 11, "c"), (2, 20, "z"), (3, None, "a"), (4, 40, None)]
    df = spark.createDataFrame(data, "u int, o int, c string")
    found = cond_count_distinct(df, ["u"], "o", "c", {"n_a": ["a"], "n_bc": ["b", "c"]})
    assert rows(found) == [(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0)]


def test_flags_and_two_level_mean(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 3, "a")], "u int, o int, c string")
    assert rows(flag_by_category(df, ["u"], "c", {"f_a": "a", "f_b": "b"})) == [(1, 1, 1), (2, 1, 0)]
    assert rows(two_level_mean(df, ["u"], ["o"], {"m": "c"})) == [(1, 1.5), (2, 1.0)]


def test_pivot_orders_columns_and_refuses_too_many(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "b", 3), (1, "a_x", 1), (2, None, 9)], "u int, c string, v int")
    wide = pivot_agg(df, ["u"], "c", "v", "SUM")
    assert wide.columns == ["u", "a_x", "b"]
    assert rows(wide) == [(1, 1, 5), (2, None, None)]
    with pytest.raises(ValueError, match="more than 1"):
        pivot_agg(df, ["u"], "c", "v", max_columns=1)


def test_rank_keeps_all_ties_and_row_number_does_not(spark):
    data = [("d", "p1", 9), ("d", "p2", 8), ("d", "p3", 7), ("d", "p4", 7), ("d", "p5", 6), (None, "q", 1)]
    df = spark.createDataFrame(data, "dept string, name string, n int")
    ranked = rows(top_k_per_group(df, ["dept"], "n", 3))
    assert ranked == [("d", "p1", 9, 1), ("d", "p2", 8, 2), ("d", "p3", 7, 3), ("d", "p4", 7, 3), (None, "q", 1, 1)]
    numbered = rows(top_k_per_group(df, ["dept"], "n", 3, "row_number", ["name"]))
    assert numbered == [("d", "p1", 9, 1), ("d", "p2", 8, 2), ("d", "p3", 7, 3), (None, "q", 1, 1)]
    with pytest.raises(ValueError):
        top_k_per_group(df, ["dept"], "n", 3, "dense")


def test_rank_counts_ties_before_the_cut(spark):
    data = [("d", f"p{i}", 5) for i in range(4)] + [("d", "late", 4)]
    df = spark.createDataFrame(data, "dept string, name string, n int")
    assert [r[3] for r in rows(top_k_per_group(df, ["dept"], "n", 3))] == [1, 1, 1, 1]


@pytest.mark.parametrize("k", [1, 3, 7])
def test_rank_against_brute_force(spark, k):
    draw = random.Random(k)
    data = [(draw.choice("abc"), f"p{i}", draw.randrange(12)) for i in range(200)]
    df = spark.createDataFrame(data, "dept string, name string, n int")
    expected = set()
    for dept, name, n in data:
        rank = 1 + sum(1 for d, _, m in data if d == dept and m > n)
        if rank <= k:
            expected.add((dept, name, n, rank))
    assert set(rows(top_k_per_group(df, ["dept"], "n", k))) == expected


def test_rank_never_orders_a_whole_group(spark, plan):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id")
    text = plan(top_k_per_group(df, ["g"], "id", 3))
    assert "WindowGroupLimit" in text


def test_top_names_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "name string")
    assert [tuple(r) for r in top_names(df, "name", 2).collect()] == [("c", 2), ("a", 1)]


def test_shares_of_subtotal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), ("b", 1)], "g string, n int")
    assert rows(partition_sum(df, ["g"], "n", "s")) == [("a", 1, 3), ("a", 2, 3), ("b", 1, 1), (None, 5, 5)]
    assert [r[3] for r in rows(ratio_to_subtotal(df, ["g"], "n", "s", "r"))] == [33.0, 67.0, 100.0, 100.0]


def test_quartiles_and_classes(spark):
    wide = spark.createDataFrame([(i, v, v * 2, None) for i, v in enumerate([0, 0, 1, 2, 3, 5, 8])], "id int, a int, b int, c int")
    cuts = quartiles(wide, ["a", "b"])
    expected = np.quantile([0, 0, 1, 2, 3, 5, 8], [0.25, 0.5, 0.75])
    assert rows(cuts)[0] == ("a", *expected) and rows(cuts)[1] == ("b", *(expected * 2))
    classes = rows(quartile_classes(wide, cuts, ["id"], ["a", "b", "c"]))
    # A value on a cut point stays below it; a measure without cut points and a null value are in the last class.
    assert [r[1] for r in classes] == [1, 1, 2, 2, 3, 4, 4]
    assert {r[3] for r in classes} == {4}
    nulls = spark.createDataFrame([(1, None)], "id int, a int")
    assert rows(quartile_classes(nulls, cuts, ["id"], ["a"])) == [(1, 4)]


@pytest.mark.parametrize("accuracy", [50, 1000, 100_000])
@pytest.mark.parametrize("kind", ["wide", "hot"])
def test_exact_quantiles_against_numpy(spark, accuracy, kind):
    """A small accuracy forces the bracket path; the hot kind has one value in a third of all rows."""
    draw = random.Random(accuracy)
    values = [draw.gauss(0, 100) if kind == "wide" or draw.random() > 0.34 else 7.5 for _ in range(3000)]
    groups = ["a" if i % 3 else "b" for i in range(3000)]
    df = spark.createDataFrame(list(zip(groups, values)), "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    for group, *found in rows(exact_quantiles(df, ["g"], "v", probs, names, accuracy)):
        mine = [v for g, v in zip(groups, values) if g == group]
        assert np.allclose(found, np.quantile(mine, probs), rtol=0, atol=1e-9)
    assert np.allclose(exact_quantiles(df, [], "v", probs, names, accuracy).first(), np.quantile(values, probs), atol=1e-9)


LINES = "order_id int, product_id int, position int"


def test_nesting_and_flattening(spark):
    orders = spark.createDataFrame([(1, "u"), (2, "v")], "order_id int, user string")
    lines = spark.createDataFrame([(1, 30, 1), (1, 20, 2), (1, 20, 2)], LINES)
    nested = nest_lines(orders, lines, "order_id", ["product_id", "position"])
    found = {r["order_id"]: [tuple(e) for e in r["details"]] for r in nested.collect()}
    assert found == {1: [(20, 2), (20, 2), (30, 1)], 2: [(None, None)]}
    flat = rows(flatten(nested, "details"))
    assert flat == [(1, "u", 20, 2), (1, "u", 20, 2), (1, "u", 30, 1), (2, "v", None, None)]


def test_a_large_order_stays_one_row(spark, plan):
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    lines = spark.range(200_000).selectExpr("1 as order_id", "cast(id % 999 as int) as product_id", "cast(id as int) as position")
    nested = nest_lines(orders, lines, "order_id", ["product_id", "position"])
    assert plan(nested).count("Range (") == 1
    assert rows(nested.selectExpr("order_id", "size(details)")) == [(1, 200_000), (2, 1)]


def test_samples_and_splits_keep_null_keys_apart_from_small_fractions(spark):
    df = spark.range(10).selectExpr("if(id < 5, null, id) as k", "id")
    assert hash_sample(df, "k", 8).count() == 8
    marked = hash_split(df, "k", 0.5)
    assert marked.where("is_eval").count() + marked.where("not is_eval").count() == 10
    many = spark.range(200_000)
    one, two = hash_fraction(many, "id", 1e-5), hash_fraction(many, "id", 1e-4)
    assert one.count() < two.count() and one.join(two, "id", "left_anti").count() == 0


def test_quantiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert rows(exact_quantiles(df, ["g"], "v", [0.5], ["m"])) == [("a", 2.0), (None, 2.0)]


def test_flatten_drops_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [(7,)])], "id int, a array<struct<x: int>>")
    assert rows(flatten(df, "a")) == [(3, 7)]


def test_lines_as_json(spark):
    lines = spark.createDataFrame([(1, 30, 2), (1, None, 1)], LINES)
    found = lines_json(lines, "order_id", ["position", "product_id"], "j").first()["j"]
    assert found == '[{"position":1,"product_id":null},{"position":2,"product_id":30}]'
    assert "\n" in lines_json(lines, "order_id", ["position", "product_id"], "j", pretty=True).first()["j"]


def digest(key, seed):
    return hashlib.md5(f"{key}{seed}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 50, 999, 1000, 5000])
def test_sample_is_the_n_smallest_digests(spark, n):
    df = spark.range(1000)
    expected = sorted(range(1000), key=lambda k: digest(k, "s"))[:n]
    assert sorted(r[0] for r in hash_sample(df, "id", n, "s").collect()) == sorted(expected)
    assert sorted(r[0] for r in hash_sample(df.repartition(5), "id", n, "s").collect()) == sorted(expected)


def test_split_and_fraction_agree(spark):
    df = spark.range(2000)
    marked = hash_split(df, "id", 0.25, "x")
    chosen = {r[0] for r in marked.filter("is_eval").collect()}
    assert chosen == {k for k in range(2000) if digest(k, "x")[:4] < "4000"}
    assert chosen == {r[0] for r in hash_fraction(df, "id", 0.25, "x").collect()}
    assert hash_fraction(df, "id", 1.0).count() == 2000


def test_categories_shared_by_output_columns(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "b"), (1, None, "a"), (2, 12, None), (3, 13, "z")], "k int, o int, c string")
    found = cond_count_distinct(df, ["k"], "o", "c", {"a": ["a", "a"], "ab": ["a", "b"], "none": []})
    assert rows(found, "k") == [(1, 1, 2, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
