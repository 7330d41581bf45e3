"""One key holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tablejobs.plans import baskets

SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def small_limits(spark):
    for key, value in SMALL_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_LIMITS:
        spark.conf.unset(key)


def hot_lines(spark):
    """A third of the lines are of product 7 and of user 0."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 120_000, 1, 8).select(
        F.when(hot, 7).otherwise(F.col("id") % 1000).alias("product_id"),
        F.col("id").alias("order_id"),
        F.when(hot, 0).otherwise(F.col("id") % 500).alias("user_id"),
    )


def test_the_join_on_a_hot_product_is_split(spark, small_limits, plan):
    products = spark.range(1000).select(F.col("id").alias("product_id"), (F.col("id") % 6).alias("department_id"))
    departments = spark.range(6).select(
        F.col("id").alias("department_id"), F.concat(F.lit("d"), F.col("id")).alias("department")
    )
    counts = baskets.user_dept_counts(hot_lines(spark), products, departments, {"one": ["d1"], "rest": ["d0", "d2", "d3", "d4", "d5"]})
    total = sum(r["one"] + r["rest"] for r in counts.collect())
    assert "skew=true" in plan(counts).split("== Initial Plan ==")[0]
    assert total == 120_000  # every order has one product, so no order is lost or counted twice


def test_counts_of_a_hot_product_are_added_up_before_the_join(spark, small_limits, plan):
    products = spark.range(1000).selectExpr("id AS product_id", "concat('p', id) AS product_name", "id % 6 AS department_id")
    departments = spark.range(6).selectExpr("id AS department_id", "concat('d', id) AS department")
    top = baskets.top_products_by_department(hot_lines(spark), products, departments, k=1)
    found = {r["department"]: (r["product_name"], r["nb_commandes"]) for r in top.collect() if r["product_name"] == "p7"}
    assert found == {"d1": ("p7", 40_000 + 80)}
