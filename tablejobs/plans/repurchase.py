"""Will a buyer of a product buy it again in the last order? Target, features and feature table.

All features come from the history: the order lines of the user's earlier orders. Most of them depend only on one row per
order, so the lines are grouped by order once (``order_summary``) and everything else is counted on that smaller table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.operators import anti_in, semi_in, star_join, sum_after_last
from tablejobs.plans.baskets import product_department

ORDER_KEYS = ("user_id", "order_id", "order_number", "days_since_prior_order")


def mark_lines(lines: DataFrame, products: DataFrame, departments: DataFrame, is_target: Column) -> DataFrame:
    """Lines with their department and whether the product is the one being scored."""
    known = product_department(products, departments).select(
        "product_id", "department", F.coalesce(is_target, F.lit(False)).alias("is_target")
    )
    return lines.join(known, "product_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))


def history_without_last(lines: DataFrame, train_lines: DataFrame) -> DataFrame:
    """Lines of the orders that are not in the last-order table."""
    return anti_in(lines, train_lines, "order_id")


def buyers(history: DataFrame) -> DataFrame:
    return history.filter("is_target").select("user_id").distinct()


def target_orders(marked_train_lines: DataFrame) -> DataFrame:
    """Last orders that hold the product."""
    return marked_train_lines.filter("is_target").select("order_id").distinct().withColumn("achat", F.lit(1))


def repurchase_target(history: DataFrame, lines: DataFrame, marked_train_lines: DataFrame) -> DataFrame:
    """Buyers of the product, with 1 where the last order holds it again, else 0."""
    again = semi_in(lines, target_orders(marked_train_lines), "order_id").select("user_id").distinct()
    flagged = buyers(history).join(again.withColumn("achat", F.lit(1)), "user_id", "left")
    return flagged.select("user_id", F.coalesce("achat", F.lit(0)).alias("cible"))


def orders_of(history: DataFrame) -> DataFrame:
    """One row per order, with whether it holds the product."""
    return history.groupBy(*ORDER_KEYS).agg(F.max("is_target").alias("has_target"))


def _distinct_departments() -> Column:
    """Departments are few, so a set of them is smaller than the extra shuffle of a distinct count."""
    return F.size(F.collect_set("department")).cast("bigint")


def order_summary(history: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """``orders_of`` with the number of lines, distinct products and departments, and one flag per department.

    Lines are first made distinct by product, so that no distinct count is left and no row is copied. ``flags`` maps output
    column to department.
    """
    per_product = history.groupBy(*ORDER_KEYS, "product_id", "department").agg(
        F.count(F.lit(1)).alias("lines"), F.max("is_target").alias("is_target")
    )
    return per_product.groupBy(*ORDER_KEYS).agg(
        F.sum("lines").alias("lines"),
        F.count("product_id").alias("products"),
        _distinct_departments().alias("departments"),
        F.max("is_target").alias("has_target"),
        *[F.max(F.when(F.col("department") == d, 1).otherwise(0)).alias(name) for name, d in flags.items()],
    )


def dept_flags(departments: list[str]) -> dict[str, str]:
    """Flag column per department name, blanks as underscores."""
    return {f"flag_{d.replace(' ', '_')}": d for d in departments}


def _count_name(flag: str) -> str:
    return flag.replace("flag_", "nb_comm_", 1)


def _per_order_totals() -> list[Column]:
    return [
        F.count("order_id").alias("nb_commandes_total"),
        F.count(F.when(F.col("has_target"), F.col("order_id"))).alias("nb_commandes_produit"),
        F.sum("lines").alias("volume_produits"),
    ]


def _delays() -> list[Column]:
    return [
        F.avg("days_since_prior_order").alias("moy_delai_comm"),
        F.min("days_since_prior_order").alias("min_delai_comm"),
        F.max("days_since_prior_order").alias("max_delai_comm"),
    ]


def _dept_columns(flags: Mapping[str, str]) -> list[Column]:
    return [
        *[F.max(f).cast("int").alias(f) for f in flags],
        *[F.sum(f).alias(_count_name(f)) for f in flags],
    ]


def _bought_last() -> list[Column]:
    return [F.max_by(F.col("has_target").cast("int"), "order_number").alias("achat_dernierachat")]


def _basket_means() -> list[Column]:
    return [F.avg("departments").alias("nb_department_moy"), F.avg("products").alias("nb_produit_moy")]


def distinct_products(history: DataFrame) -> DataFrame:
    """Distinct products and departments per user. A product has one department, so one distinct pass serves both."""
    once = history.select("user_id", "product_id", "department").distinct()
    return once.groupBy("user_id").agg(
        F.count("product_id").alias("nb_produits_dist"), _distinct_departments().alias("nb_department")
    )


def feat_consumption(per_order: DataFrame, history: DataFrame) -> DataFrame:
    return per_order.groupBy("user_id").agg(*_per_order_totals()).join(distinct_products(history), "user_id")


def feat_delay(per_order: DataFrame) -> DataFrame:
    """Days between orders; the missing delay of a first order is left out of the mean."""
    return per_order.groupBy("user_id").agg(*_delays())


def feat_dept_flags(per_order: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    return per_order.groupBy("user_id").agg(*_dept_columns(flags))


def feat_bought_last(per_order: DataFrame) -> DataFrame:
    return per_order.groupBy("user_id").agg(*_bought_last())


def feat_basket_means(per_order: DataFrame) -> DataFrame:
    return per_order.groupBy("user_id").agg(*_basket_means())


def feat_cart_rank(history: DataFrame) -> DataFrame:
    """Position of the product in the cart, over distinct (order, position)."""
    places = history.filter("is_target").select("user_id", "order_id", "add_to_cart_order").distinct()
    return places.groupBy("user_id").agg(
        F.avg("add_to_cart_order").alias("moy_rang_comm"),
        F.min("add_to_cart_order").alias("min_rang_comm"),
        F.max("add_to_cart_order").alias("max_rang_comm"),
    )


def feat_delay_last_order(target: DataFrame, lines: DataFrame, train_lines: DataFrame) -> DataFrame:
    """Delay carried by the last order; users whose last order has no lines are absent."""
    last = semi_in(lines.select("order_id", "user_id", "days_since_prior_order"), train_lines, "order_id")
    once = semi_in(last, target, "user_id").select("user_id", "days_since_prior_order").distinct()
    return once.withColumnRenamed("days_since_prior_order", "delai_dercomm")


def delay_after_product(per_order: DataFrame) -> DataFrame:
    """Days from the last order with the product to the last order; only users with a later order."""
    return sum_after_last(
        per_order, "user_id", "order_number", F.col("has_target"), "days_since_prior_order", "delai_dernier_achat"
    )


def feat_delay_since_product(target: DataFrame, per_order: DataFrame) -> DataFrame:
    """The same for every user of the target: 0 where there is no later order."""
    filled = F.when(F.col("delai_dernier_achat") >= 0, F.col("delai_dernier_achat")).otherwise(0.0)
    joined = target.select("user_id").join(delay_after_product(per_order), "user_id", "left")
    return joined.select("user_id", filled.alias("delai_dernier_achat"))


def feature_table(
    target: DataFrame,
    history: DataFrame,
    per_order: DataFrame,
    lines: DataFrame,
    train_lines: DataFrame,
    flags: Mapping[str, str],
) -> DataFrame:
    """All features on one row per user of the target.

    ``history`` holds the lines of those users and ``per_order`` their ``order_summary``, best as a written table: it is read
    three times. All features of the orders come from one grouping by user.
    """
    parts = [
        per_order.groupBy("user_id").agg(
            *_per_order_totals(), *_delays(), *_dept_columns(flags), *_bought_last(), *_basket_means()
        ),
        distinct_products(history),
        feat_cart_rank(history),
        feat_delay_last_order(target, lines, train_lines),
        feat_delay_since_product(target, per_order),
    ]
    return star_join(target, parts, "user_id")


def share_columns(df: DataFrame, total: str, shares: Mapping[str, str]) -> DataFrame:
    """Counts replaced by their share of ``total``; ``shares`` maps output column to count column."""
    kept = [c for c in df.columns if c not in shares.values()]
    return df.select(*kept, *[(F.col(c) / F.col(total)).alias(name) for name, c in shares.items()])


def feature_table_ratios(features: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    counts = ["nb_commandes_produit", *[_count_name(f) for f in flags]]
    shares = {c.replace("nb_", "part_", 1): c for c in counts}
    return share_columns(features, "nb_commandes_total", shares)
