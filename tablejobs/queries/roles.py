"""The driver tables in the roles of basket and hire tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TARGET_BRAND = "Brand#13"
LONG_TRIP = 100.0
HIRE_DAY = "2024-01-10"
HIRE_MOMENT = "2024-01-10 00:00:00"
WEEKEND = (0, 6)
MORNING = (6, 7, 8)
HOT_SHARE = 10_000
HOT_ROWS = 100_000
DEPARTMENTS = ["economy", "large", "medium", "promo", "small", "standard"]
# Two departments share one column, as "other" and "missing" do in the job this stands for.
GROUPS = {
    "nb_commandes_economy": ["economy"],
    "nb_commandes_large": ["large"],
    "nb_commandes_medium": ["medium"],
    "nb_commandes_promo": ["promo"],
    "nb_commandes_others": ["small", "standard"],
}
MEASURES = list(GROUPS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _hot_users(base: DataFrame) -> DataFrame:
    """Users with more than one order in HOT_SHARE, and more than HOT_ROWS: by that share at most HOT_SHARE users."""
    limit = base.agg(F.greatest(F.count(F.lit(1)) / HOT_SHARE, F.lit(HOT_ROWS))).scalar()
    counts = base.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > limit).select("user_id", F.lit(True).alias("hot"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders numbered per user by (date, id), with the days since the user's previous order.

    The window runs over a user, or over one month of a hot user; the months of hot users are then put in order from their
    counts. So no task has to order more than a sliver of the table, and the table is shuffled once.
    """
    base = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day")
    )
    marked = base.join(F.broadcast(_hot_users(base)), "user_id", "left")  # at most HOT_SHARE rows
    chunked = marked.withColumn("month", F.when(F.col("hot"), F.trunc("day", "month")))
    in_order = Window.partitionBy("user_id", "month").orderBy("day", "order_id")
    numbered = chunked.select(
        "order_id",
        "user_id",
        "day",
        "month",
        F.row_number().over(in_order).alias("nth"),
        F.lag("day").over(in_order).alias("prev"),
        F.lead("order_id").over(in_order).isNull().alias("closes"),
    )
    months = chunked.filter("hot").groupBy("user_id", "month").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last_day"))
    by_month = Window.partitionBy("user_id").orderBy("month")
    earlier = by_month.rowsBetween(Window.unboundedPreceding, -1)
    offsets = months.select(
        "user_id",
        "month",
        F.sum("n").over(earlier).alias("before"),
        F.max("last_day").over(earlier).alias("prev_month_day"),
        F.lead("month").over(by_month).isNotNull().alias("goes_on"),
    )
    placed = numbered.join(offsets, ["user_id", "month"], "left")
    is_last = F.col("closes") & ~F.coalesce("goes_on", F.lit(False))
    last_set = F.when(F.col("user_id") % 3 != 0, "train").otherwise("test")
    return placed.select(
        "order_id",
        "user_id",
        F.when(is_last, last_set).otherwise("prior").alias("eval_set"),
        (F.col("nth") + F.coalesce("before", F.lit(0))).cast("bigint").alias("order_number"),
        (F.dayofweek("day") - 1).cast("bigint").alias("order_dow"),
        (F.col("order_id") % 24).alias("order_hour_of_day"),
        F.datediff("day", F.coalesce("prev", "prev_month_day")).cast("double").alias("days_since_prior_order"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").cast("bigint").alias("add_to_cart_order"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("reordered"),
    )


def lines_of(spark: SparkSession, sf: str, eval_set: str) -> DataFrame:
    """The lines of the orders of one evaluation set, as one of the two line tables."""
    wanted = orders(spark, sf).filter(F.col("eval_set") == eval_set)
    return lines(spark, sf).join(wanted.select("order_id"), "order_id", "left_semi")


def departments(spark: SparkSession, sf: str) -> DataFrame:
    """Department list; the window runs over the distinct names only."""
    names = table(spark, sf, "part").select(F.lower("p_type").alias("department")).distinct()
    return names.withColumn("department_id", F.row_number().over(Window.orderBy("department")))


def products(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("aisle_id"),
        F.col("p_brand").alias("brand"),
        F.lower("p_type").alias("department"),
    )
    return part.join(departments(spark, sf), "department", "left").drop("department")


def is_target() -> Column:
    return F.col("brand") == TARGET_BRAND


def hires(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("hire_id"),
        F.col("event_type").alias("start_station_name"),
        F.col("user_id").alias("start_station_id"),
        F.col("value").alias("duration"),
        F.col("ts").alias("start_date"),
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "events").select(F.col("user_id").alias("id")).distinct()
    return ids.select(
        "id",
        (F.lit(51.4) + F.col("id") % 15 * F.lit(0.01)).alias("latitude"),
        (F.lit(-0.2) + F.floor(F.col("id") / 15) * F.lit(0.02)).alias("longitude"),
    )


USER_GROUPS = ("economy", "large", "medium", "promo", "others")
ROLES_SQL = """
WITH numbered AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS d,
         row_number() OVER u AS number, lag(o_orderdate) OVER u AS prev,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders
  FROM orders WINDOW u AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
b_orders AS (
  SELECT order_id, user_id,
         CASE WHEN number < n_orders THEN 'prior' WHEN user_id % 3 <> 0 THEN 'train' ELSE 'test' END AS eval_set,
         CAST(number AS BIGINT) AS order_number, CAST(dayofweek(d) AS BIGINT) AS order_dow,
         CAST(order_id % 24 AS BIGINT) AS order_hour_of_day,
         CAST(date_diff('day', prev, d) AS DOUBLE) AS days_since_prior_order
  FROM numbered),
b_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_linenumber AS BIGINT) AS add_to_cart_order,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS reordered
  FROM lineitem),
b_departments AS (
  SELECT department, row_number() OVER (ORDER BY department) AS department_id
  FROM (SELECT DISTINCT lower(p_type) AS department FROM part)),
b_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_size AS aisle_id, p_brand AS brand, department_id
  FROM part LEFT JOIN b_departments ON department = lower(p_type)),
train_lines AS (SELECT l.* FROM b_lines l WHERE order_id IN (SELECT order_id FROM b_orders WHERE eval_set = 'train')),
prior_lines AS (SELECT l.* FROM b_lines l WHERE order_id IN (SELECT order_id FROM b_orders WHERE eval_set = 'prior')),
scope AS (SELECT * FROM b_orders WHERE user_id IN (SELECT user_id FROM b_orders WHERE eval_set = 'train')),
scope_lines AS (SELECT * FROM b_lines WHERE order_id IN (SELECT order_id FROM scope WHERE eval_set IN ('prior', 'train'))),
flat AS (
  SELECT s.order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order,
         product_id, add_to_cart_order, reordered
  FROM scope s JOIN scope_lines l ON s.order_id = l.order_id),
named AS (
  SELECT f.*, p.product_name, d.department, p.brand = 'Brand#13' AS is_target
  FROM flat f LEFT JOIN b_products p ON f.product_id = p.product_id
  LEFT JOIN b_departments d ON p.department_id = d.department_id),
user_groups AS (
  SELECT DISTINCT user_id, order_id, CASE WHEN department IN ('small', 'standard') THEN 'others' ELSE department END AS grp FROM named),
users AS (
  SELECT user_id, """ + ", ".join(f"count(*) FILTER (WHERE grp = '{g}') AS nb_commandes_{g}" for g in USER_GROUPS) + """
  FROM user_groups GROUP BY user_id),
long AS (
  SELECT 'nb_commandes_economy' AS measure, nb_commandes_economy AS v FROM users
  UNION ALL SELECT 'nb_commandes_large', nb_commandes_large FROM users
  UNION ALL SELECT 'nb_commandes_medium', nb_commandes_medium FROM users
  UNION ALL SELECT 'nb_commandes_promo', nb_commandes_promo FROM users
  UNION ALL SELECT 'nb_commandes_others', nb_commandes_others FROM users),
cuts AS (
  SELECT measure, quantile_cont(v, 0.25e0) AS cut_1, quantile_cont(v, 0.5e0) AS cut_2, quantile_cont(v, 0.75e0) AS cut_3
  FROM long GROUP BY measure),
history AS (SELECT * FROM named WHERE order_id NOT IN (SELECT order_id FROM train_lines)),
cust AS (SELECT DISTINCT user_id FROM history WHERE is_target),
target AS (
  SELECT user_id, CASE WHEN max(CASE WHEN n.is_target AND n.eval_set = 'train' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS cible
  FROM cust JOIN named n USING (user_id) GROUP BY user_id),
mine AS (SELECT * FROM history WHERE user_id IN (SELECT user_id FROM cust)),
hires AS (
  SELECT event_id AS hire_id, event_type AS start_station_name, user_id AS start_station_id, value AS duration,
         ts AS start_date FROM events),
stations AS (
  SELECT id, 51.4e0 + (id % 15) * 0.01e0 AS latitude, -0.2e0 + floor(id / 15) * 0.02e0 AS longitude
  FROM (SELECT DISTINCT user_id AS id FROM events))
"""


def roles_sql(select: str) -> str:
    return f"{ROLES_SQL.strip()}\n{select.strip()}"
