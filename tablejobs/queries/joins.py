"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.operators import (
    anti_in,
    lookup_constants,
    quartiles,
    semi_in,
    star_join,
    sum_after_last,
    top_names,
)
from tablejobs.plans import baskets, hires
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.repurchase import Inputs
from tablejobs.queries.roles import roles_sql, table
from tablejobs.queries.rows import user_counts
from tablejobs.sources import materialize


@query(
    "inner_join",
    "SELECT o_orderkey, o_custkey, l_partkey, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'",
)
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).drop("l_orderkey")


@query(
    "left_join_dims",
    roles_sql("""
    SELECT l.order_id, l.product_id, product_name, department FROM b_lines l
    LEFT JOIN b_products p ON l.product_id = p.product_id
    LEFT JOIN b_departments d ON p.department_id = d.department_id
    """),
)
def left_join_dims(spark: SparkSession, sf: str) -> DataFrame:
    dims = baskets.product_department(roles.products(spark, sf), roles.departments(spark, sf))
    lines = roles.lines(spark, sf).select("order_id", "product_id")
    return lines.join(dims.select("product_id", "product_name", "department"), "product_id", "left")


@query(
    "left_join_chain",
    roles_sql("""
    SELECT t.*, a.* EXCLUDE (user_id), b.* EXCLUDE (user_id), c.* EXCLUDE (user_id), d.* EXCLUDE (user_id),
           e.* EXCLUDE (user_id), f.* EXCLUDE (user_id), g.* EXCLUDE (user_id), h.* EXCLUDE (user_id)
    FROM target t
    LEFT JOIN (SELECT user_id, count(DISTINCT order_id) AS n_orders FROM mine GROUP BY 1) a ON t.user_id = a.user_id
    LEFT JOIN (SELECT user_id, count(*) AS n_lines FROM mine GROUP BY 1) b ON t.user_id = b.user_id
    LEFT JOIN (SELECT user_id, min(order_number) AS first_order FROM mine GROUP BY 1) c ON t.user_id = c.user_id
    LEFT JOIN (SELECT user_id, max(order_number) AS last_order FROM mine GROUP BY 1) d ON t.user_id = d.user_id
    LEFT JOIN (SELECT user_id, max(days_since_prior_order) AS longest FROM mine GROUP BY 1) e ON t.user_id = e.user_id
    LEFT JOIN (SELECT user_id, max(add_to_cart_order) AS cart FROM mine GROUP BY 1) f ON t.user_id = f.user_id
    LEFT JOIN (SELECT user_id, CAST(sum(reordered) AS BIGINT) AS again FROM mine GROUP BY 1) g ON t.user_id = g.user_id
    LEFT JOIN (SELECT user_id, count(*) AS n_target FROM mine WHERE is_target GROUP BY 1) h ON t.user_id = h.user_id
    """),
)
def left_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Eight grouped inputs on one key; all have one row per user, so no join grows."""
    data = Inputs(spark, sf)
    users = data.mine.groupBy("user_id")
    parts = [
        data.mine.select("user_id", "order_id").distinct().groupBy("user_id").agg(F.count("order_id").alias("n_orders")),
        users.agg(F.count(F.lit(1)).alias("n_lines")),
        users.agg(F.min("order_number").alias("first_order")),
        users.agg(F.max("order_number").alias("last_order")),
        users.agg(F.max("days_since_prior_order").alias("longest")),
        users.agg(F.max("add_to_cart_order").alias("cart")),
        users.agg(F.sum("reordered").alias("again")),
        data.mine.filter("is_target").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_target")),
    ]
    return star_join(data.target, parts, "user_id")


@query(
    "semi_join_in",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def semi_join_in(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return semi_in(orders, orders.filter(F.col("o_orderpriority") == "1-URGENT"), "o_custkey").drop("o_orderpriority")


@query(
    "semi_join_distinct",
    """
    WITH wanted AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT o.o_orderkey, o.o_totalprice FROM orders o JOIN wanted w ON w.l_orderkey = o.o_orderkey
    """,
)
def semi_join_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Join to a distinct list, stated as the semi join it is."""
    wanted = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").withColumnRenamed("l_orderkey", "o_orderkey")
    return semi_in(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), wanted, "o_orderkey")


@query(
    "anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    returned = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").withColumnRenamed("l_orderkey", "o_orderkey")
    return anti_in(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), returned, "o_orderkey")


@query(
    "cross_join_params",
    roles_sql("""
    , params AS (SELECT [0, 6] AS weekend_days, [6, 7, 8] AS morning_th)
    SELECT CASE WHEN list_contains(weekend_days, order_dow) THEN 1 ELSE 0 END AS weekend,
           CASE WHEN list_contains(morning_th, order_hour_of_day) THEN 1 ELSE 0 END AS morning, count(1) AS orders
    FROM scope, params GROUP BY 1, 2
    """),
)
def cross_join_params(spark: SparkSession, sf: str) -> DataFrame:
    """The one-row parameter table becomes literals, so nothing is joined."""
    scoped = baskets.scope_orders(roles.orders(spark, sf))
    return baskets.orders_by_moment(scoped, roles.WEEKEND, roles.MORNING)


@query(
    "explode_join",
    roles_sql("SELECT s.order_id, user_id, product_id FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id"),
)
def explode_join(spark: SparkSession, sf: str) -> DataFrame:
    scoped = baskets.scope_orders(roles.orders(spark, sf)).select("order_id", "user_id")
    nested = baskets.orders_nested(scoped, roles.lines(spark, sf))
    return baskets.orders_flat(nested).select("order_id", "user_id", "product_id")


@query(
    "lookup_join_constant",
    roles_sql("""
    SELECT u.*, e.cut_2 AS median_economy, l.cut_2 AS median_large, m.cut_2 AS median_medium, p.cut_2 AS median_promo,
           n.cut_2 AS median_none
    FROM users u
    LEFT JOIN cuts e ON e.measure = 'nb_commandes_economy'
    LEFT JOIN cuts l ON l.measure = 'nb_commandes_large'
    LEFT JOIN cuts m ON m.measure = 'nb_commandes_medium'
    LEFT JOIN cuts p ON p.measure = 'nb_commandes_promo'
    LEFT JOIN cuts n ON n.measure = 'nb_commandes_none'
    """),
)
def lookup_join_constant(spark: SparkSession, sf: str) -> DataFrame:
    users = materialize(user_counts(spark, sf), "users")
    names = {f"median_{d}": f"nb_commandes_{d}" for d in ("economy", "large", "medium", "promo", "none")}
    return lookup_constants(users, quartiles(users, roles.MEASURES), "measure", "cut_2", names)


@query(
    "composite_key_join",
    roles_sql("""
    SELECT n.user_id, n.order_number, n.product_id FROM named n
    JOIN (SELECT user_id, max(order_number) AS order_number FROM named GROUP BY user_id) m
      ON n.user_id = m.user_id AND n.order_number = m.order_number
    """),
)
def composite_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Content of each user's last order with lines."""
    flat = Inputs(spark, sf).flat.select("user_id", "order_number", "product_id")
    last = flat.groupBy("user_id").agg(F.max("order_number").alias("order_number"))
    return flat.join(last, ["user_id", "order_number"])


@query(
    "dim_join_station",
    roles_sql("SELECT hire_id, latitude, longitude FROM hires JOIN stations ON start_station_id = id"),
)
def dim_join_station(spark: SparkSession, sf: str) -> DataFrame:
    joined = hires.with_station(roles.hires(spark, sf), roles.stations(spark, sf))
    return joined.select("hire_id", "latitude", "longitude")


@query(
    "after_event_range",
    """
    SELECT a.user_id, CAST(sum(CAST(a.value AS DECIMAL(18, 2))) AS DOUBLE) AS value_after FROM events a
    LEFT JOIN (SELECT user_id, max(event_id) AS last_id FROM events WHERE event_type = 'purchase' GROUP BY user_id) b
      ON a.user_id = b.user_id
    WHERE b.last_id < a.event_id GROUP BY a.user_id
    """,
)
def after_event_range(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    bought = F.col("event_type") == "purchase"
    sums = sum_after_last(events, "user_id", "event_id", bought, "value", "value_after")
    return sums.withColumn("value_after", F.col("value_after").cast("double"))


@query(
    "array_membership_filter",
    """
    SELECT p_brand AS name, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS sizes FROM part
    WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 3) GROUP BY p_brand
    """,
)
def array_membership_filter(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_brand").alias("name"), "p_size")
    top = F.broadcast(top_names(part, "name", 3).select("name"))  # three rows
    return part.join(top, "name", "left_semi").groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("sizes")
    )
