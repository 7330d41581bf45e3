"""Composite jobs on hand-made baskets and hires, and the invariants between the feature tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tablejobs.plans import baskets, hires, repurchase
from tablejobs.queries import roles
from tablejobs.queries.repurchase import Inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [
            (1, "u", "prior", 1, 0, 7, None),
            (2, "u", "prior", 2, 3, 12, 5.0),
            (3, "u", "train", 3, 6, 8, 9.0),
            (4, "v", "prior", 1, 1, 6, None),
            (5, "v", "test", 2, 2, 23, 3.0),
            (6, "w", "prior", 1, 4, 9, None),
            (7, "w", "train", 2, 5, 10, 2.0),
        ],
        "order_id int, user_id string, eval_set string, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order double",
    )
    lines = spark.createDataFrame(
        [(1, 10, 1, 0), (1, 11, 2, 0), (2, 12, 1, 0), (3, 10, 1, 1), (4, 10, 1, 0), (6, 10, 3, 0), (7, 12, 1, 0)],
        "order_id int, product_id int, add_to_cart_order int, reordered int",
    )
    products = spark.createDataFrame(
        [(10, "Organic Cucumber", 1, 1), (11, "Diapers Size 2", 56, 2), (12, "Wipes Size 3", 56, 2), (13, "Diapers", 56, 9)],
        "product_id int, product_name string, aisle_id int, department_id int",
    )
    departments = spark.createDataFrame([(1, "dry goods"), (2, "babies")], "department_id int, department string")
    return orders, lines, products, departments


def test_scope(shop):
    orders, lines, *_ = shop
    scoped = baskets.scope_orders(orders)
    assert {r[0] for r in scoped.select("order_id").collect()} == {1, 2, 3, 6, 7}
    train = lines.filter("order_id IN (3, 7)")
    prior = lines.filter("order_id NOT IN (3, 7)")
    assert baskets.scope_order_lines(train, prior, scoped).count() == 6


def test_order_without_lines_keeps_one_empty_line(shop):
    orders, lines, *_ = shop
    flat = baskets.orders_flat(baskets.orders_nested(orders, lines))
    assert flat.filter("order_id = 5").select("product_id").first()[0] is None
    assert flat.count() == 8


def test_product_reports(shop):
    _, lines, products, departments = shop
    assert rows(baskets.flag_dist(products, "organic", "flag_organic")) == [(0, 3), (1, 1)]
    sizes = baskets.product_size_dist(products, F.col("aisle_id") == 56, "wipes", "size ([0-9])")
    assert [tuple(r) for r in sizes.collect()] == [("2", 1), (None, 1)]
    top = baskets.top_products_by_department(lines, products, departments, k=1)
    assert rows(top) == [("babies", "Wipes Size 3", 2, 1), ("dry goods", "Organic Cucumber", 4, 1)]


def test_counts_pivot_and_blanks(shop):
    orders, lines, products, departments = shop
    flat = baskets.order_lines(orders, lines)
    counts = baskets.user_dept_counts(flat, products, departments, {"nb_food": ["dry goods"], "nb_babies": ["babies"]})
    assert rows(counts) == [("u", 2, 2), ("v", 1, 0), ("w", 1, 1)]
    wide = baskets.user_dept_pivot(baskets.user_department_orders(flat, products, departments))
    assert wide.columns == ["user_id", "babies", "dry_goods"]
    assert rows(wide) == [("u", 2, 2), ("v", None, 1), ("w", 1, 1)]


def test_repurchase_features(shop):
    orders, lines, products, departments = shop
    marked = repurchase.mark_lines(lines, products, departments, F.col("product_id") == 10)
    flat = baskets.order_lines(baskets.scope_orders(orders), marked)
    train = flat.filter("eval_set = 'train'")
    history = repurchase.history_without_last(flat, train)
    target = repurchase.repurchase_target(history, flat, train)
    assert rows(target) == [("u", 1), ("w", 0)]
    flags = repurchase.dept_flags(["dry goods", "babies"])
    per_order = repurchase.order_summary(history, flags)
    table = repurchase.feature_table(target, history, per_order, flat, train, flags)
    found = {r["user_id"]: r.asDict() for r in table.collect()}
    u, w = found["u"], found["w"]
    assert (u["nb_commandes_total"], u["nb_commandes_produit"], u["volume_produits"], u["nb_produits_dist"]) == (2, 1, 3, 3)
    assert (u["nb_department"], u["moy_delai_comm"], u["achat_dernierachat"]) == (2, 5.0, 0)
    assert (u["flag_dry_goods"], u["nb_comm_babies"], u["nb_department_moy"], u["nb_produit_moy"]) == (1, 2, 1.5, 1.5)
    assert (u["moy_rang_comm"], u["delai_dercomm"], u["delai_dernier_achat"]) == (1.0, 9.0, 5.0)
    assert (w["moy_delai_comm"], w["achat_dernierachat"], w["delai_dernier_achat"], w["moy_rang_comm"]) == (None, 1, 0.0, 3.0)
    ratios = repurchase.feature_table_ratios(table, flags)
    share = ratios.filter("user_id = 'u'").first()
    assert (share["part_commandes_produit"], share["part_comm_babies"]) == (0.5, 1.0)
    assert not [c for c in ratios.columns if c.startswith("nb_comm_") or c == "nb_commandes_produit"]


def test_every_feature_table_has_the_users_of_the_target(spark):
    data = Inputs(spark, SF)
    users = {r[0] for r in data.target.select("user_id").collect()}
    complete = "feat_consumption feat_delay feat_dept_flags feat_bought_last feat_basket_means feat_cart_rank feat_delay_since_product feature_table feature_table_ratios"
    for key in complete.split():
        found = [r[0] for r in contract.queries()[key](spark, SF).select("user_id").collect()]
        assert len(found) == len(users) and set(found) == users, key
    last = [r[0] for r in contract.queries()["feat_delay_last_order"](spark, SF).select("user_id").collect()]
    assert len(last) == len(set(last)) and set(last) <= users


@pytest.mark.parametrize("hot_rows", [20, 100_000])
def test_orders_of_one_very_busy_user(spark, tmp_path, monkeypatch, hot_rows):
    """A user with most of the orders, numbered by month (at the low limit), comes out as from one window."""
    monkeypatch.setattr(roles, "HOT_ROWS", hot_rows)
    base = spark.range(600).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 7).cast("bigint").alias("o_custkey"),
        F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, int(id * 37 % 400))").alias("o_orderdate"),
    )
    base.write.parquet(f"{tmp_path}/orders.parquet")
    found = roles.orders(spark, str(tmp_path)).select("order_id", "eval_set", "order_number", "days_since_prior_order").toPandas()
    plain = base.toPandas().sort_values(["o_custkey", "o_orderdate", "o_orderkey"])
    plain["number"] = plain.groupby("o_custkey").cumcount() + 1
    plain["delay"] = plain.groupby("o_custkey")["o_orderdate"].diff().dt.days
    both = found.merge(plain, left_on="order_id", right_on="o_orderkey")
    assert len(both) == 600
    assert (both["order_number"] == both["number"]).all()
    last = both["number"] == both.groupby("o_custkey")["number"].transform("max")
    assert ((both["eval_set"] == "prior") == ~last).all()
    assert both["days_since_prior_order"].fillna(-1).eq(both["delay"].fillna(-1)).all()


def test_hire_jobs(spark, plan):
    data = [("A", 1, 10.0, "2024-01-02 08:00:00"), ("A", 1, 30.0, "2024-01-03 08:00:00"), ("B", 2, 5.0, "2024-01-03 09:00:00"), ("C", 3, 5.0, "2024-01-01 09:00:00")]
    df = spark.createDataFrame(data, "start_station_name string, start_station_id int, duration double, d string")
    df = df.withColumn("start_date", F.to_timestamp("d"))
    moment = "2024-01-01 12:00:00"
    assert rows(hires.hires_by_top_stations(df, moment, 1)) == [("A", 2)]
    assert hires.top_station_array(df, moment, 3).first()[0] == ["A", "B"]
    assert rows(hires.avg_duration(df, ["A", "C"], moment)) == [("A", 20.0)]
    assert hires.after_date(df, "2024-01-02").count() == 2
    places = spark.createDataFrame([(1, 51.5, -0.12), (2, 51.5, -0.12)], "id int, latitude double, longitude double")
    cells = rows(hires.geo_cell_rollup(df, places, (4, 2)))
    assert cells == [("gc", 3, 15.0), ("gcpu", 3, 15.0)]


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(contract.queries()["filter_date_from"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text
