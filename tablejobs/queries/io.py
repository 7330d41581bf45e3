"""Sources and sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs import sources
from tablejobs.operators import flatten
from tablejobs.plans import baskets
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.roles import roles_sql, table
from tablejobs.session import work_dir
from tablejobs.sources.files import NULL


@query("csv_load_inferred", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_load_inferred(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    path = sources.write_csv(part, work_dir(spark, "csv"))
    # Detection picks the narrowest type that fits, so the wanted types are restored by name.
    loaded = sources.read_csv_inferred(spark, path, null=NULL)
    return loaded.select(*[F.col(f.name).cast(f.dataType) for f in part.schema])


@query("csv_load_schema", "SELECT * FROM customer")
def csv_load_schema(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    path = sources.write_csv(customer, work_dir(spark, "csv"))
    return sources.read_csv(spark, path, customer.schema, null=NULL)


@query("csv_text_roundtrip", "SELECT * FROM documents")
def csv_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Text with quotes, line breaks and blanks at its ends, written and read back."""
    documents = table(spark, sf, "documents")
    path = sources.write_csv(documents, work_dir(spark, "csv"))
    return sources.read_csv(spark, path, documents.schema, multi_line=True, null=NULL)


@query(
    "local_lookup_join",
    """
    SELECT label, urgent, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM orders LEFT JOIN (VALUES ('1-URGENT', 'now', 1), ('2-HIGH', 'soon', 1), ('3-MEDIUM', 'later', 0),
                                  ('5-LOW', 'last', 0)) AS p(o_orderpriority, label, urgent) USING (o_orderpriority)
    GROUP BY label, urgent
    """,
)
def local_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    records = pd.DataFrame(
        [
            {"label": "now", "urgent": 1},
            {"label": "soon", "urgent": 1},
            {"label": "later", "urgent": 0},
            {"label": "last", "urgent": 0},
        ],
        index=pd.Index(["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], name="o_orderpriority"),
    )
    labelled = sources.lookup_join(table(spark, sf, "orders"), records, "o_orderpriority")
    return labelled.groupBy("label", F.col("urgent").cast("int").alias("urgent")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query("ctas_roundtrip", "SELECT p_brand AS corpus, count(*) AS n FROM part GROUP BY p_brand")
def ctas_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "part").groupBy(F.col("p_brand").alias("corpus")).agg(F.count(F.lit(1)).alias("n"))
    return sources.create_table(counts, work_dir(spark, "ctas"))


@query(
    "replace_table",
    "SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_returnflag",
)
def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    path = work_dir(spark, "replace")
    sources.create_table(lineitem.select("l_returnflag").distinct(), path)
    sums = lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    return sources.replace_table(sums, path)


@query(
    "temp_table",
    roles_sql("""
    SELECT weekend, sum(orders)::BIGINT AS orders, max(orders) AS largest FROM (
      SELECT CASE WHEN order_dow IN (0, 6) THEN 1 ELSE 0 END AS weekend,
             CASE WHEN order_hour_of_day IN (6, 7, 8) THEN 1 ELSE 0 END AS morning, count(*) AS orders
      FROM scope GROUP BY ALL) GROUP BY weekend
    """),
)
def temp_table(spark: SparkSession, sf: str) -> DataFrame:
    scoped = baskets.scope_orders(roles.orders(spark, sf))
    counts = baskets.orders_by_moment(scoped, roles.WEEKEND, roles.MORNING)
    sources.temp_table(counts, "orders_we")
    return spark.sql("SELECT weekend, sum(orders) AS orders, max(orders) AS largest FROM orders_we GROUP BY weekend")


@query("clustered_write", roles_sql("SELECT * FROM b_lines"))
def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    return sources.clustered_write(roles.lines(spark, sf), work_dir(spark, "clustered"), "order_id", "product_id")


@query(
    "nested_json_export",
    roles_sql("""
    SELECT s.order_id, s.user_id, s.eval_set, s.order_number, s.days_since_prior_order,
           l.product_id, l.add_to_cart_order, l.reordered
    FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id
    """),
)
def nested_json_export(spark: SparkSession, sf: str) -> DataFrame:
    scoped = baskets.scope_orders(roles.orders(spark, sf)).drop("order_dow", "order_hour_of_day")
    nested = baskets.orders_nested(scoped, roles.lines(spark, sf))
    path = sources.export_json(nested, work_dir(spark, "json"))
    return flatten(sources.read_json(spark, path, nested.schema), "details")


@query(
    "json_pieces_export",
    roles_sql("""
    , placed_lines AS (
      SELECT s.order_id, s.user_id, s.eval_set, s.order_number, s.days_since_prior_order,
             json_object('product_id', l.product_id, 'add_to_cart_order', l.add_to_cart_order, 'reordered', l.reordered) AS line,
             row_number() OVER (PARTITION BY s.order_id ORDER BY l.product_id, l.add_to_cart_order, l.reordered) AS nth
      FROM scope s LEFT JOIN scope_lines l ON s.order_id = l.order_id)
    SELECT CASE WHEN nth > 1 THEN ',' || line ELSE rtrim(CAST(json_object(
             'order_id', order_id, 'user_id', user_id, 'eval_set', eval_set, 'order_number', order_number,
             'days_since_prior_order', days_since_prior_order) AS VARCHAR), '}') || ',"details":[' || line END AS value
    FROM placed_lines UNION ALL SELECT ']}' FROM scope
    """),
)
def json_pieces_export(spark: SparkSession, sf: str) -> DataFrame:
    """Text lines of the nested export without an array cell, read back."""
    scoped = baskets.scope_orders(roles.orders(spark, sf)).drop("order_dow", "order_hour_of_day")
    scoped = scoped.select("order_id", "user_id", "eval_set", "order_number", "days_since_prior_order")
    fields = ["product_id", "add_to_cart_order", "reordered"]
    return spark.read.text(sources.export_json_pieces(scoped, roles.lines(spark, sf), "order_id", fields, work_dir(spark, "pieces")))


@query(
    "append_generated_rows",
    """
    SELECT DISTINCT CAST(l_quantity AS BIGINT) AS experience, 30000e0 + 1000 * CAST(l_quantity AS BIGINT) AS revenu
    FROM lineitem WHERE l_quantity > 20
    """,
)
def append_generated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows generated from the values present in a table, written in two appends."""
    values = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("bigint").alias("experience"))
    rows = values.filter(F.col("experience") > 20).distinct()
    rows = rows.withColumn("revenu", F.lit(30000.0) + F.lit(1000) * F.col("experience"))
    path = work_dir(spark, "append")
    sources.append_rows(rows.filter(F.col("experience") <= 40), path)
    return sources.append_rows(rows.filter(F.col("experience") > 40), path)
