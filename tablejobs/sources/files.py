"""CSV and JSON files in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


NULL = "\\N"  # how written files show a null; the empty text stays empty
DIALECT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv_inferred(
    spark: SparkSession, path: str, sampling: float = 1.0, multi_line: bool = False, null: str | None = None
) -> DataFrame:
    """CSV with one header row, column types detected. Detection reads the file once more; ``sampling`` shortens that pass.
    ``multi_line`` and ``null`` as for ``read_csv``."""
    options = {} if null is None else {"nullValue": null, "emptyValue": ""}
    return spark.read.csv(path, inferSchema=True, samplingRatio=sampling, mode="FAILFAST", multiLine=multi_line, **DIALECT, **options)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False, null: str | None = None
) -> DataFrame:
    """CSV with a given column list; the header row is skipped, quotes in quoted fields are doubled, a bad row is an error.

    With ``multi_line`` quoted fields may hold line breaks; such a file is read by one task. ``null`` is the text that stands
    for a null (``NULL`` in files of ``write_csv``); without it empty fields are null.
    """
    options = {} if null is None else {"nullValue": null, "emptyValue": ""}
    return spark.read.schema(schema).csv(path, mode="FAILFAST", multiLine=multi_line, **DIALECT, **options)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV that ``read_csv(…, multi_line=True, null=NULL)`` reads back unchanged."""
    df.write.csv(path, nullValue=NULL, emptyValue="", quoteAll=True, **DIALECT)
    return path


def export_json(df: DataFrame, path: str) -> str:
    """One JSON document per line, nested columns included."""
    df.write.option("ignoreNullFields", "false").json(path)
    return path


def export_json_pieces(
    parents: DataFrame, lines: DataFrame, on: str, fields: Sequence[str], path: str, name: str = "details", parts: int | None = None
) -> str:
    """Parents with an array of their lines as JSON text, where a parent may have more lines than fit into a cell or a task.

    The files, one after another by name, are one document for each parent, ordered by ``on``; a text line is the head of a
    parent with its first line, a further line, or the end. Lines are ordered by ``fields``. Ranges of (parent, line) are sorted
    and written, so a parent with many lines fills several files. ``on`` is unique among ``parents``; a parent without lines has
    one of nulls, as in ``nest_lines``; lines without parent are left out, equal lines are all kept.
    """
    parts = parts or int(parents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    options = {"ignoreNullFields": "false"}
    counted = lines.groupBy(on, *fields).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__line", F.struct(*fields))
    none = F.struct(*[F.lit(None).cast(lines.schema[f].dataType).alias(f) for f in fields])
    first = counted.groupBy(on).agg(F.min("__line").alias("__first"))
    headed = parents.join(first, on, "left").withColumn("__first", F.coalesce("__first", none))
    parent = F.to_json(F.struct(*parents.columns), options)
    head = F.concat(F.expr("substring(__parent, 1, length(__parent) - 1)"), F.lit(f',"{name}":['), F.to_json("__first", options))
    heads = headed.withColumn("__parent", parent).select(
        F.col(on).alias("key"), F.explode(F.array(F.struct(F.lit(0).alias("part"), head.alias("value")), F.struct(F.lit(2).alias("part"), F.lit("]}").alias("value")))).alias("p")
    )
    heads = heads.select("key", "p.part", none.alias("line"), F.lit(0).cast("bigint").alias("copy"), "p.value")
    of_parent = headed.select(F.col(on).alias("key"), "__first")
    rest = counted.join(of_parent, F.col(on) == F.col("key"))
    rest = rest.withColumn("__left", F.col("__copies") - (F.col("__line") == F.col("__first")).cast("int")).filter("__left > 0")
    rest = rest.select(
        "key", F.lit(1).alias("part"), F.col("__line").alias("line"), F.explode(F.sequence(F.lit(1).cast("bigint"), "__left")).alias("copy"),
        F.concat(F.lit(","), F.to_json("__line", options)).alias("value"),
    )
    order = ["key", "part", "line", "copy"]
    pieces = heads.unionByName(rest).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces.select("value").write.text(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read an export back. Without a schema JSON widens integers and reorders the columns."""
    return spark.read.schema(schema).json(path)
