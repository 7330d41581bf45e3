"""Market baskets: scope, nesting, product reports, user counts and quartile classes.

Tables: orders (order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order),
order lines (order_id, product_id, add_to_cart_order, reordered), products (product_id, product_name, aisle_id,
department_id), departments (department_id, department).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.functions import extract_or_null, has_word, underscored
from tablejobs.operators import (
    cond_count_distinct,
    flatten,
    nest_lines,
    pivot_agg,
    quartile_classes,
    quartiles,
    ratio_to_subtotal,
    semi_in,
    top_k_per_group,
)

LINE_FIELDS = ("product_id", "add_to_cart_order", "reordered")


def scope_orders(orders: DataFrame) -> DataFrame:
    """All orders of the users who have a train order."""
    return semi_in(orders, orders.filter(F.col("eval_set") == "train"), "user_id")


def scope_order_lines(train_lines: DataFrame, prior_lines: DataFrame, scoped: DataFrame) -> DataFrame:
    """Train and prior lines of the scoped orders. The union comes first: one join, one shuffle of the orders."""
    return semi_in(train_lines.unionByName(prior_lines), scoped, "order_id")


def orders_nested(scoped: DataFrame, lines: DataFrame) -> DataFrame:
    return nest_lines(scoped, lines, "order_id", LINE_FIELDS)


def orders_flat(nested: DataFrame) -> DataFrame:
    return flatten(nested, "details")


def order_lines(scoped: DataFrame, lines: DataFrame) -> DataFrame:
    """The flat table without the round trip through arrays: order columns on every line."""
    return scoped.join(lines, "order_id")


def flag_dist(products: DataFrame, word: str, name: str) -> DataFrame:
    """Number of products with and without a word in their name."""
    flagged = products.select(has_word("product_name", word).alias(name))
    return flagged.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def product_size_dist(products: DataFrame, scope: Column, excluded: str, pattern: str) -> DataFrame:
    """Products of a shelf without ``excluded`` in their name, by the size named in them (null if none is)."""
    name = F.lower("product_name")
    kept = products.filter(scope & ~name.contains(excluded))
    sized = kept.select(extract_or_null(name, pattern).alias("size"))
    return sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last("size"))


def product_department(products: DataFrame, departments: DataFrame) -> DataFrame:
    return products.join(departments, "department_id", "left")


def orders_by_product_name(lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Lines per (department, product name), counted per product before the product table is joined."""
    per_product = lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_product.join(product_department(products, departments), "product_id", "left")
    return named.groupBy("department", "product_name").agg(F.sum("n").alias("nb_commandes"))


def top_products_by_department(
    lines: DataFrame, products: DataFrame, departments: DataFrame, k: int = 3, ties: str = "rank"
) -> DataFrame:
    counts = orders_by_product_name(lines, products, departments)
    return top_k_per_group(counts, ["department"], "nb_commandes", k, ties, ["product_name"])


def with_department(lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    named = product_department(products, departments).select("product_id", "department")
    return lines.join(named, "product_id", "left")


def user_dept_counts(
    lines: DataFrame, products: DataFrame, departments: DataFrame, groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per user, the number of orders with a product of each department group; ``groups`` names the output columns."""
    labelled = with_department(lines.select("user_id", "order_id", "product_id"), products, departments)
    return cond_count_distinct(labelled, ["user_id"], "order_id", "department", groups)


def user_department_orders(lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """One row per (user, order, department), with a 1 to add up."""
    labelled = with_department(lines.select("user_id", "order_id", "product_id"), products, departments)
    once = labelled.select("user_id", "order_id", underscored("department").alias("departement")).distinct()
    return once.withColumn("commande", F.lit(1))


def user_dept_pivot(department_orders: DataFrame, max_columns: int = 30) -> DataFrame:
    """The rows of ``user_department_orders``, best as a written table, with one column per department: they are read twice."""
    return pivot_agg(department_orders, ["user_id"], "departement", "commande", "sum", max_columns)


def dept_quartiles(users: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Cut points of each count over all users, those with no order in the department included."""
    return quartiles(users, measures)


def user_quartile_classes(users: DataFrame, cuts: DataFrame, measures: Sequence[str]) -> DataFrame:
    return quartile_classes(users, cuts, ["user_id"], measures)


def orders_by_moment(orders: DataFrame, weekend: Sequence[int], morning: Sequence[int]) -> DataFrame:
    """Orders counted by weekend and morning flags; the day and hour sets are plain literals."""
    flags = orders.select(
        F.when(F.col("order_dow").isin(list(weekend)), 1).otherwise(0).alias("weekend"),
        F.when(F.col("order_hour_of_day").isin(list(morning)), 1).otherwise(0).alias("morning"),
    )
    return flags.groupBy("weekend", "morning").agg(F.count(F.lit(1)).alias("orders"))


def weekend_morning_share(orders: DataFrame, weekend: Sequence[int], morning: Sequence[int]) -> DataFrame:
    counts = orders_by_moment(orders, weekend, morning)
    return ratio_to_subtotal(counts, ["weekend"], "orders", "orders_soustotal", "ratio_morning")
