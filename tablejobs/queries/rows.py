"""Projection, conditional columns, filters, sorting, sampling and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.functions import day_type
from tablejobs.operators import hash_sample, quartiles, star_except, star_join
from tablejobs.plans import baskets, hires, repurchase
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.roles import roles_sql, table
from tablejobs.sources import materialize


@query(
    "project_rename",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS total, o_orderstatus AS status FROM orders",
)
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
    )


@query("star_except", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def select_star_except(spark: SparkSession, sf: str) -> DataFrame:
    return star_except(table(spark, sf, "customer"), "c_name", "c_acctbal")


@query(
    "multi_star_except",
    """
    SELECT c.*, o.* EXCLUDE (c_custkey), n.* EXCLUDE (c_custkey), e.* EXCLUDE (c_custkey)
    FROM customer c
    LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS nb_orders, max(o_totalprice) AS top_price
               FROM orders GROUP BY 1) o ON c.c_custkey = o.c_custkey
    LEFT JOIN (SELECT o_custkey AS c_custkey, count(DISTINCT o_orderpriority) AS nb_priorities
               FROM orders GROUP BY 1) n ON c.c_custkey = n.c_custkey
    LEFT JOIN (SELECT user_id AS c_custkey, count(*) AS nb_events, max(value) AS top_value
               FROM events GROUP BY 1) e ON c.c_custkey = e.c_custkey
    """,
)
def multi_star_except(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    events = table(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    parts = [
        orders.groupBy("c_custkey").agg(
            F.count(F.lit(1)).alias("nb_orders"), F.max("o_totalprice").alias("top_price")
        ),
        orders.groupBy("c_custkey").agg(F.countDistinct("o_orderpriority").alias("nb_priorities")),
        events.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("nb_events"), F.max("value").alias("top_value")),
    ]
    return star_join(table(spark, sf, "customer"), parts, "c_custkey")


@query(
    "ratio_columns",
    """
    SELECT o_custkey, nb_total, nb_f / nb_total AS part_f, nb_o / nb_total AS part_o, nb_p / nb_total AS part_p FROM (
      SELECT o_custkey, count(*) AS nb_total, count(*) FILTER (o_orderstatus = 'F') AS nb_f,
             count(*) FILTER (o_orderstatus = 'O') AS nb_o, count(*) FILTER (o_orderstatus = 'P') AS nb_p
      FROM orders GROUP BY o_custkey)
    """,
)
def ratio_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    counts = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("nb_total"),
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"nb_{s.lower()}") for s in "FOP"],
    )
    return repurchase.share_columns(counts, "nb_total", {f"part_{s}": f"nb_{s}" for s in "fop"})


@query(
    "case_bucket",
    """
    SELECT p_partkey, CASE WHEN p_size <= 10 THEN 1 WHEN p_size <= 25 THEN 2 WHEN p_size <= 40 THEN 3 ELSE 4 END AS size_class
    FROM part
    """,
)
def case_bucket(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    label = F.when(size <= 10, 1).when(size <= 25, 2).when(size <= 40, 3).otherwise(4)
    return table(spark, sf, "part").select("p_partkey", label.alias("size_class"))


@query(
    "if_label",
    roles_sql("""
    SELECT hire_id, CASE WHEN dayofweek(start_date) BETWEEN 1 AND 5 THEN 'weekday' ELSE 'weekend' END AS dayofweek,
           CASE WHEN duration > 100 THEN 'long' ELSE 'court' END AS type_trajet
    FROM hires
    """),
)
def if_label(spark: SparkSession, sf: str) -> DataFrame:
    return roles.hires(spark, sf).select(
        "hire_id", day_type("start_date").alias("dayofweek"), hires.trip_type(roles.LONG_TRIP).alias("type_trajet")
    )


@query(
    "constant_column",
    "SELECT DISTINCT l_orderkey AS order_id, 1 AS achat FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#13'",
)
def constant_column(spark: SparkSession, sf: str) -> DataFrame:
    marked = repurchase.mark_lines(
        roles.lines(spark, sf), roles.products(spark, sf), roles.departments(spark, sf), roles.is_target()
    )
    return repurchase.target_orders(marked)


@query("linear_formula", "SELECT p_partkey, p_size AS experience, 30000e0 + 1000 * p_size AS revenu FROM part")
def linear_formula(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT p_partkey, p_size AS experience, :const + :pente * p_size AS revenu FROM {part}",
        args={"const": 30000.0, "pente": 1000},
        part=table(spark, sf, "part"),
    )


@query("positional_params", "SELECT p_partkey, 30000e0 + 1500 * p_size AS revenu FROM part")
def positional_params(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT p_partkey, ? + ? * p_size AS revenu FROM {part}", args=[30000.0, 1500], part=table(spark, sf, "part")
    )


@query(
    "struct_field_access",
    roles_sql("""
    SELECT product_id, count(*) AS n, CAST(sum(add_to_cart_order) AS BIGINT) AS places
    FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id GROUP BY product_id
    """),
)
def struct_field_access(spark: SparkSession, sf: str) -> DataFrame:
    scoped = baskets.scope_orders(roles.orders(spark, sf)).select("order_id")
    exploded = baskets.orders_nested(scoped, roles.lines(spark, sf)).select(F.explode("details").alias("details"))
    return exploded.groupBy(F.col("details.product_id").alias("product_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("details.add_to_cart_order").alias("places")
    )


@query(
    "filter_compare",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity > 10 AND l_quantity <= 40 AND l_discount >= 0.02e0 AND l_linestatus <> 'F'
    """,
)
def filter_compare(spark: SparkSession, sf: str) -> DataFrame:
    kept = table(spark, sf, "lineitem").filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_quantity") > 10)
        & (F.col("l_quantity") <= 40)
        & (F.col("l_discount") >= 0.02)
        & (F.col("l_linestatus") != "F")
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "filter_params",
    """
    SELECT word, word_count FROM (SELECT p_name AS word, p_brand AS corpus, count(*) AS word_count FROM part GROUP BY 1, 2)
    WHERE corpus = 'Brand#13' AND word_count >= 2 ORDER BY word_count DESC, word
    """,
)
def filter_params(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT p_name AS word, word_count
        FROM (SELECT p_name, p_brand, count(*) AS word_count FROM {part} GROUP BY p_name, p_brand)
        WHERE p_brand = :corpus AND word_count >= :min_word_count
        ORDER BY word_count DESC, word
        """,
        args={"corpus": "Brand#13", "min_word_count": 2},
        part=table(spark, sf, "part"),
    )


@query(
    "filter_in_list",
    "SELECT p_partkey, p_type FROM part WHERE upper(p_type) IN ('PROMO', 'LARGE') AND p_size IN (1, 7, 49)",
)
def filter_in_list(spark: SparkSession, sf: str) -> DataFrame:
    sizes = F.array(F.lit(1), F.lit(7), F.lit(49))
    kept = table(spark, sf, "part").filter(
        F.upper("p_type").isin("PROMO", "LARGE") & F.array_contains(sizes, F.col("p_size"))
    )
    return kept.select("p_partkey", "p_type")


@query(
    "filter_like",
    "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%widget%' AND lower(p_name) NOT LIKE '%red%'",
)
def filter_like(spark: SparkSession, sf: str) -> DataFrame:
    name = F.lower("p_name")
    return table(spark, sf, "part").filter(name.like("%widget%") & ~name.like("%red%")).select("p_partkey", "p_name")


@query("filter_between", "SELECT event_id, value FROM events WHERE dayofweek(ts) + 1 BETWEEN 2 AND 6")
def filter_between(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(F.dayofweek("ts").between(2, 6)).select("event_id", "value")


@query("filter_date_from", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-10'")
def filter_date_from(spark: SparkSession, sf: str) -> DataFrame:
    kept = hires.after_date(roles.hires(spark, sf), roles.HIRE_DAY)
    return kept.select(F.col("hire_id").alias("event_id"), F.col("start_station_id").alias("user_id"))


@query(
    "filter_is_null",
    "SELECT o_orderkey FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL",
)
def filter_is_null(spark: SparkSession, sf: str) -> DataFrame:
    """The literal form; ``anti_join`` states the same as an anti join."""
    keys = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    orders = table(spark, sf, "orders").select("o_orderkey")
    joined = orders.join(keys, orders.o_orderkey == keys.l_orderkey, "left")
    return joined.filter(F.col("l_orderkey").isNull()).select("o_orderkey")


@query(
    "filter_random_fraction",
    roles_sql("""
    SELECT CASE WHEN duration > 100 THEN 'long' ELSE 'court' END AS type_trajet, count(*) AS n FROM hires
    WHERE start_date::DATE > DATE '2024-01-10' AND substr(md5(concat(hire_id, 'trip')), 1, 15) < '1999999999999a0' GROUP BY 1
    """),
)
def filter_random_fraction(spark: SparkSession, sf: str) -> DataFrame:
    recent = hires.after_date(roles.hires(spark, sf), roles.HIRE_DAY)
    return hires.trip_type_rate(recent, roles.LONG_TRIP, "hire_id", 0.1, "trip")


@query(
    "top_n",
    """
    SELECT p_name AS name, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY p_name ORDER BY total DESC, name LIMIT 10
    """,
)
def top_n(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(spark, sf).orderBy(F.desc("total"), "name").limit(10)


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity per product name, added up per product before the names are joined."""
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"))
    joined = per_part.join(part, per_part.l_partkey == part.p_partkey)
    return joined.groupBy("name").agg(F.sum("quantity").cast("bigint").alias("total"))


@query(
    "top_n_param",
    """
    SELECT p_name AS name, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY p_name ORDER BY total DESC, name LIMIT 5
    """,
)
def top_n_param(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT name, total FROM {totals} ORDER BY total DESC, name LIMIT :limit",
        args={"limit": 5},
        totals=_totals(spark, sf),
    )


@query(
    "order_by",
    roles_sql("SELECT order_id, days_since_prior_order FROM b_orders ORDER BY days_since_prior_order NULLS LAST, order_id"),
)
def order_by(spark: SparkSession, sf: str) -> DataFrame:
    ordered = roles.orders(spark, sf).orderBy(F.asc_nulls_last("days_since_prior_order"), "order_id")
    return ordered.select("order_id", "days_since_prior_order")


@query(
    "random_sample_n",
    roles_sql("SELECT * FROM users ORDER BY md5(concat(user_id, 'sample')), user_id LIMIT 100"),
)
def random_sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sample(materialize(user_counts(spark, sf), "users"), "user_id", 100, "sample")


def user_counts(spark: SparkSession, sf: str) -> DataFrame:
    flat = baskets.order_lines(baskets.scope_orders(roles.orders(spark, sf)), roles.lines(spark, sf))
    return baskets.user_dept_counts(flat, roles.products(spark, sf), roles.departments(spark, sf), roles.GROUPS)


@query("limit_any")
def limit_any(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").limit(1)


@query("union_all", roles_sql("SELECT * FROM scope_lines"))
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    scoped = baskets.scope_orders(roles.orders(spark, sf))
    train = roles.lines_of(spark, sf, "train").join(scoped.select("order_id"), "order_id")
    prior = roles.lines_of(spark, sf, "prior").join(scoped.select("order_id"), "order_id")
    return train.unionByName(prior)


@query(
    "union_all_many",
    """
    SELECT 'l_quantity' AS measure, CAST(min(l_quantity) AS DOUBLE) AS lowest, CAST(max(l_quantity) AS DOUBLE) AS highest FROM lineitem
    UNION ALL SELECT 'l_discount', min(l_discount), max(l_discount) FROM lineitem
    UNION ALL SELECT 'l_tax', min(l_tax), max(l_tax) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem
    """,
)
def union_all_many(spark: SparkSession, sf: str) -> DataFrame:
    """One branch per column over one table: the columns become rows of a single scan."""
    measures = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    long = table(spark, sf, "lineitem").select(*measures).unpivot([], measures, "measure", "value")
    return long.groupBy("measure").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query(
    "percentile_over_all",
    """
    SELECT DISTINCT quantile_cont(p_size, 0.25e0) OVER () AS cut_1, quantile_cont(p_size, 0.5e0) OVER () AS cut_2,
           quantile_cont(p_size, 0.75e0) OVER () AS cut_3 FROM part
    """,
)
def percentile_over_all(spark: SparkSession, sf: str) -> DataFrame:
    return quartiles(table(spark, sf, "part").select("p_size"), ["p_size"]).drop("measure")
