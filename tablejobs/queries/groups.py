"""Aggregation, pivots and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.functions import day_type, hour_text
from tablejobs.operators import (
    cond_count_distinct,
    flag_by_category,
    lines_json,
    nest_lines,
    partition_sum,
    pivot_agg,
    quartiles,
    ratio_to_subtotal,
    top_k_per_group,
    two_level_mean,
)
from tablejobs.plans import baskets, hires, repurchase
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.repurchase import Inputs
from tablejobs.queries.roles import roles_sql, table
from tablejobs.queries.rows import user_counts


@query("group_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("group_sum", "SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY l_partkey")
def group_sum(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("total"))


@query("group_avg", "SELECT l_suppkey, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY l_suppkey")
def group_avg(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("avg_quantity"))


@query(
    "group_min_max",
    "SELECT o_custkey, min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders GROUP BY o_custkey",
)
def group_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")
    )


@query(
    "count_distinct",
    """
    SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) AS n
    FROM lineitem GROUP BY l_suppkey
    """,
)
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_partkey").alias("parts"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "cond_count_distinct",
    """
    SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned,
           count(DISTINCT CASE WHEN l_returnflag IN ('A', 'N') THEN l_orderkey END) AS others
    FROM lineitem GROUP BY l_suppkey
    """,
)
def count_distinct_by_category(spark: SparkSession, sf: str) -> DataFrame:
    groups = {"returned": ["R"], "others": ["A", "N"]}
    return cond_count_distinct(table(spark, sf, "lineitem"), ["l_suppkey"], "l_orderkey", "l_returnflag", groups)


@query(
    "cond_count_distinct_overlap",
    """
    SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned,
           count(DISTINCT CASE WHEN l_returnflag IN ('A', 'R') THEN l_orderkey END) AS closed,
           count(DISTINCT CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN l_orderkey END) AS every,
           count(DISTINCT CASE WHEN l_returnflag = 'none' THEN l_orderkey END) AS none
    FROM lineitem GROUP BY l_suppkey
    """,
)
def count_distinct_by_shared_category(spark: SparkSession, sf: str) -> DataFrame:
    """Output columns that share categories."""
    groups = {"returned": ["R"], "closed": ["A", "R"], "every": ["A", "N", "R"], "none": ["none"]}
    return cond_count_distinct(table(spark, sf, "lineitem"), ["l_suppkey"], "l_orderkey", "l_returnflag", groups)


@query(
    "flag_max_case",
    """
    SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS flag_r,
           max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS flag_a,
           max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS flag_n
    FROM lineitem GROUP BY l_orderkey
    """,
)
def flag_max_case(spark: SparkSession, sf: str) -> DataFrame:
    names = {"flag_r": "R", "flag_a": "A", "flag_n": "N"}
    return flag_by_category(table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", names)


@query("group_only", "SELECT p_brand AS corpus FROM part GROUP BY p_brand")
def group_only(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_brand").alias("corpus")).distinct()


@query("select_distinct", "SELECT DISTINCT l_partkey, l_returnflag, 1 AS present FROM lineitem")
def select_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", F.lit(1).alias("present")).distinct()


@query(
    "distinct_over_group",
    roles_sql("""
    SELECT DISTINCT t.user_id, avg(days_since_prior_order) AS moy_delai_comm
    FROM target t JOIN (SELECT DISTINCT user_id, order_id, days_since_prior_order FROM history) h ON t.user_id = h.user_id
    GROUP BY t.user_id, t.cible
    """),
)
def distinct_over_group(spark: SparkSession, sf: str) -> DataFrame:
    """The target column in the grouping and the outer DISTINCT change nothing: one row per user either way."""
    return repurchase.feat_delay(repurchase.orders_of(Inputs(spark, sf).mine)).select("user_id", "moy_delai_comm").distinct()


@query(
    "collect_structs",
    roles_sql("""
    SELECT o.order_id, user_id,
           CAST(to_json(list({'product_id': product_id, 'add_to_cart_order': add_to_cart_order, 'reordered': reordered}
                             ORDER BY product_id, add_to_cart_order, reordered)) AS VARCHAR) AS details
    FROM b_orders o LEFT JOIN b_lines l ON o.order_id = l.order_id GROUP BY o.order_id, user_id
    """),
)
def collect_structs(spark: SparkSession, sf: str) -> DataFrame:
    orders = roles.orders(spark, sf).select("order_id", "user_id")
    nested = nest_lines(orders, roles.lines(spark, sf), "order_id", baskets.LINE_FIELDS)
    return nested.withColumn("details", F.to_json("details", {"ignoreNullFields": "false"}))


@query(
    "top_names_array",
    roles_sql("""
    SELECT array_to_string(list(start_station_name ORDER BY n DESC, start_station_name)[1:3], '|') AS top_stations
    FROM (SELECT start_station_name, count(*) AS n FROM hires WHERE start_date > TIMESTAMP '2024-01-10' GROUP BY 1)
    """),
)
def top_names_array(spark: SparkSession, sf: str) -> DataFrame:
    top = hires.top_station_array(roles.hires(spark, sf), roles.HIRE_MOMENT)
    return top.select(F.array_join("top_stations", "|").alias("top_stations"))


@query(
    "ordered_structs_json",
    """
    SELECT l_orderkey, CAST(to_json(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_returnflag': l_returnflag}
                                    ORDER BY l_linenumber, l_partkey, l_returnflag)) AS VARCHAR) AS lines
    FROM lineitem GROUP BY l_orderkey
    """,
)
def ordered_structs_json(spark: SparkSession, sf: str) -> DataFrame:
    return lines_json(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"),
        "l_orderkey",
        ["l_linenumber", "l_partkey", "l_returnflag"],
        "lines",
    )


@query(
    "count_if",
    roles_sql("SELECT user_id, count_if(order_dow IN (0, 6))::BIGINT AS nb_we, count(*) AS nb FROM b_orders GROUP BY user_id"),
)
def count_if(spark: SparkSession, sf: str) -> DataFrame:
    return roles.orders(spark, sf).groupBy("user_id").agg(
        F.count_if(F.col("order_dow").isin(*roles.WEEKEND)).alias("nb_we"), F.count(F.lit(1)).alias("nb")
    )


@query(
    "two_level_avg",
    """
    SELECT l_suppkey, avg(orders) AS orders FROM (
      SELECT l_suppkey, l_partkey, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_suppkey, l_partkey)
    GROUP BY l_suppkey
    """,
)
def two_level_avg(spark: SparkSession, sf: str) -> DataFrame:
    return two_level_mean(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_partkey"], {"orders": "l_orderkey"})


@query(
    "group_by_alias",
    roles_sql("""
    SELECT CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN 'weekday' ELSE 'weekend' END AS day,
           printf('%02d', hour(start_date)) AS hourofday, count(*) AS n FROM hires GROUP BY 1, 2
    """),
)
def group_by_alias(spark: SparkSession, sf: str) -> DataFrame:
    labelled = roles.hires(spark, sf).select(
        day_type("start_date").alias("day"), hour_text("start_date").alias("hourofday")
    )
    return labelled.groupBy("day", "hourofday").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pivot_sum",
    """
    SELECT l_suppkey, CAST(sum(l_quantity) FILTER (l_returnflag = 'A') AS BIGINT) AS A,
           CAST(sum(l_quantity) FILTER (l_returnflag = 'N') AS BIGINT) AS N,
           CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS R
    FROM lineitem GROUP BY l_suppkey
    """,
)
def pivot_sum(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem").withColumn("quantity", F.col("l_quantity").cast("bigint"))
    return pivot_agg(lineitem, ["l_suppkey"], "l_returnflag", "quantity", "SUM", 30)


@query("quartiles_by_group", roles_sql("SELECT * FROM cuts"))
def quartiles_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return quartiles(user_counts(spark, sf), roles.MEASURES)


@query("global_count", "SELECT count(*) AS n FROM lineitem WHERE l_discount <> 0")
def global_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").filter(F.col("l_discount") != 0).agg(F.count(F.lit(1)).alias("n"))


@query(
    "top_k_per_group",
    """
    SELECT p_brand, p_name, n, rk FROM (
      SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY n DESC) AS rk
      FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY p_brand, p_name)) WHERE rk <= 3
    """,
)
def rank_per_group(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "part").groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, ["p_brand"], "n", 3)


@query(
    "partition_sum",
    "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n, CAST(sum(o_orderkey) OVER (PARTITION BY o_custkey) AS BIGINT) AS key_sum FROM orders",
)
def window_partition_sum(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.lit(1).alias("one"))
    counted = partition_sum(orders, ["o_custkey"], "one", "n").drop("one")
    return partition_sum(counted, ["o_custkey"], "o_orderkey", "key_sum")


@query(
    "ratio_to_subtotal",
    """
    SELECT l_returnflag, l_linestatus, n, CAST(sum(n) OVER (PARTITION BY l_returnflag) AS BIGINT) AS subtotal,
           round(n / sum(n) OVER (PARTITION BY l_returnflag) * 100) AS ratio
    FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus)
    """,
)
def share_of_subtotal(spark: SparkSession, sf: str) -> DataFrame:
    counts = group_count(spark, sf)
    return ratio_to_subtotal(counts, ["l_returnflag"], "n", "subtotal", "ratio")
