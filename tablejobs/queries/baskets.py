"""Basket jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.plans import baskets as plan
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.roles import roles_sql
from tablejobs.queries.rows import user_counts
from tablejobs.sources import materialize


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    return plan.order_lines(plan.scope_orders(roles.orders(spark, sf)), roles.lines(spark, sf))


def _dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return roles.products(spark, sf), roles.departments(spark, sf)


@query("scope_orders", roles_sql("SELECT * FROM scope"))
def scope_orders(spark: SparkSession, sf: str) -> DataFrame:
    return plan.scope_orders(roles.orders(spark, sf))


@query("scope_order_lines", roles_sql("SELECT * FROM scope_lines"))
def scope_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    scoped = plan.scope_orders(roles.orders(spark, sf))
    return plan.scope_order_lines(roles.lines_of(spark, sf, "train"), roles.lines_of(spark, sf, "prior"), scoped)


@query(
    "orders_nested",
    roles_sql("""
    SELECT s.order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order,
           CAST(to_json(list({'product_id': product_id, 'add_to_cart_order': add_to_cart_order, 'reordered': reordered}
                             ORDER BY product_id, add_to_cart_order, reordered)) AS VARCHAR) AS details
    FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id GROUP BY ALL
    """),
)
def orders_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = plan.orders_nested(plan.scope_orders(roles.orders(spark, sf)), roles.lines(spark, sf))
    return nested.withColumn("details", F.to_json("details", {"ignoreNullFields": "false"}))


@query(
    "orders_flat",
    roles_sql("""
    SELECT s.order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order,
           product_id, add_to_cart_order, reordered
    FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id
    """),
)
def orders_flat(spark: SparkSession, sf: str) -> DataFrame:
    nested = plan.orders_nested(plan.scope_orders(roles.orders(spark, sf)), roles.lines(spark, sf))
    return plan.orders_flat(nested)


@query(
    "product_size_dist",
    """
    SELECT size, count(*) AS n FROM (
      SELECT nullif(regexp_extract(lower(p_brand || ' ' || p_name), '#([1-9])[0-9] .*(?:widget|bolt)', 1), '') AS size
      FROM part WHERE p_size <= 7 AND lower(p_brand || ' ' || p_name) NOT LIKE '%red%') GROUP BY size ORDER BY size
    """,
)
def product_size_dist(spark: SparkSession, sf: str) -> DataFrame:
    """The name here is brand and name together: only some of them carry the digit looked for."""
    products = roles.products(spark, sf).withColumn("product_name", F.concat_ws(" ", "brand", "product_name"))
    return plan.product_size_dist(products, F.col("aisle_id") <= 7, "red", "#([1-9])[0-9] .*(?:widget|bolt)")


@query(
    "organic_flag_dist",
    "SELECT CASE WHEN lower(p_name) LIKE '%widget%' THEN 1 ELSE 0 END AS flag, count(*) AS n FROM part GROUP BY 1",
)
def organic_flag_dist(spark: SparkSession, sf: str) -> DataFrame:
    return plan.flag_dist(roles.products(spark, sf), "widget", "flag")


TOP3_SQL = """
SELECT department, product_name, nb_commandes, rk FROM (
  SELECT *, rank() OVER (PARTITION BY department ORDER BY nb_commandes DESC) AS rk FROM (
    SELECT department, product_name, count(*) AS nb_commandes FROM named GROUP BY department, product_name))
WHERE rk <= 3
"""


@query("top3_products_by_dept", roles_sql(TOP3_SQL))
def top3_products_by_dept(spark: SparkSession, sf: str) -> DataFrame:
    return plan.top_products_by_department(_flat(spark, sf), *_dims(spark, sf))


@query("user_dept_counts", roles_sql("SELECT * FROM users"))
def user_dept_counts(spark: SparkSession, sf: str) -> DataFrame:
    return user_counts(spark, sf)


_PIVOT = ", ".join(f"CAST(sum(CASE WHEN department = '{d}' THEN 1 END) AS BIGINT) AS {d}" for d in roles.DEPARTMENTS)


@query(
    "user_dept_pivot",
    roles_sql(f"SELECT user_id, {_PIVOT} FROM (SELECT DISTINCT user_id, order_id, department FROM named) GROUP BY user_id"),
)
def user_dept_pivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = plan.user_department_orders(_flat(spark, sf), *_dims(spark, sf))
    return plan.user_dept_pivot(materialize(rows, "users_commandes"))


@query("dept_quartiles", roles_sql("SELECT * FROM cuts"))
def dept_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    return plan.dept_quartiles(user_counts(spark, sf), roles.MEASURES)


def _class_sql(measure: str) -> str:
    cut = f"(SELECT {{}} FROM cuts WHERE measure = '{measure}')"
    cases = " ".join(f"WHEN {measure} <= {cut.format(f'cut_{i}')} THEN {i}" for i in (1, 2, 3))
    return f"CASE {cases} ELSE 4 END AS {measure}"


CLASSES_SQL = f"SELECT user_id, {', '.join(_class_sql(m) for m in roles.MEASURES)} FROM users"


def user_classes(spark: SparkSession, sf: str) -> DataFrame:
    users = materialize(user_counts(spark, sf), "users")  # read for the cut points and again for the classes
    return plan.user_quartile_classes(users, plan.dept_quartiles(users, roles.MEASURES), roles.MEASURES)


@query("user_quartile_classes", roles_sql(CLASSES_SQL))
def user_quartile_classes(spark: SparkSession, sf: str) -> DataFrame:
    return user_classes(spark, sf)


@query(
    "weekend_morning_share",
    roles_sql("""
    SELECT weekend, morning, orders, CAST(sum(orders) OVER (PARTITION BY weekend) AS BIGINT) AS orders_soustotal,
           round(orders / sum(orders) OVER (PARTITION BY weekend) * 100) AS ratio_morning
    FROM (SELECT CASE WHEN order_dow IN (0, 6) THEN 1 ELSE 0 END AS weekend,
                 CASE WHEN order_hour_of_day IN (6, 7, 8) THEN 1 ELSE 0 END AS morning, count(*) AS orders
          FROM scope GROUP BY ALL)
    """),
)
def weekend_morning_share(spark: SparkSession, sf: str) -> DataFrame:
    scoped = plan.scope_orders(roles.orders(spark, sf))
    return plan.weekend_morning_share(scoped, roles.WEEKEND, roles.MORNING)
