import pandas as pd
import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablejobs import sources
from tablejobs.session import SETTINGS, SHUFFLE_BYTES, folder_bytes, tune, work_dir
from tablejobs.sources.files import NULL


def test_work_dir_is_new_and_shared(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_tune_only_raises_the_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark, input_bytes=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        tune(spark, input_bytes=100 * SHUFFLE_BYTES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        tune(spark, input_bytes=10**15)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(-(-(10**15) // SHUFFLE_BYTES))
        assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_folder_size_is_that_of_its_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/a/b.parquet")
    files = [p for p in tmp_path.rglob("*.parquet") if p.is_file()]
    assert len(files) == 3 and folder_bytes(spark, str(tmp_path)) == sum(p.stat().st_size for p in files)


def test_csv_both_ways(spark):
    df = spark.createDataFrame([(1, "a,b", 1.5), (2, None, None)], "id int, name string, x double")
    path = sources.write_csv(df, work_dir(spark, "csv"))
    assert sources.read_csv_inferred(spark, path, null=NULL).dtypes == [("id", "int"), ("name", "string"), ("x", "double")]
    assert rows(sources.read_csv(spark, path, df.schema, null=NULL)) == rows(df)


def test_csv_keeps_quotes_breaks_blanks_and_empties(spark):
    texts = ['say "hi", ok', "two\nlines", " blanks ", "", None, "back\\slash", '"', ","]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, name string")
    path = sources.write_csv(df, work_dir(spark, "csv"))
    assert rows(sources.read_csv(spark, path, df.schema, multi_line=True, null=NULL)) == rows(df)


def test_ordinary_exported_csv_and_a_bad_row(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('id,name\n1,"say ""hi"", ok"\n2,\n')
    bad.write_text("id,name\n1,a\nx,b\n")
    assert rows(sources.read_csv(spark, str(good), "id int, name string")) == [(1, 'say "hi", ok'), (2, None)]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        sources.read_csv(spark, str(bad), "id int, name string").collect()


def test_nested_json_keeps_types_and_nulls(spark):
    df = spark.createDataFrame([(1, [(2, None)]), (3, None)], "id int, a array<struct<x: int, y: string>>")
    path = sources.export_json(df, work_dir(spark, "json"))
    assert rows(sources.read_json(spark, path, df.schema)) == rows(df)


def test_named_index_becomes_a_column(spark):
    named = pd.DataFrame({"v": [1, 2]}, index=pd.Index(["a", "b"], name="k"))
    assert sources.local_table(spark, named).columns == ["k", "v"]
    assert sources.local_table(spark, pd.DataFrame({"v": [1]})).columns == ["v"]


def test_only_a_short_list_is_broadcast(spark, plan, monkeypatch):
    facts = spark.range(10).withColumnRenamed("id", "k")
    records = pd.DataFrame({"k": [1, 2], "v": ["a", "b"]})
    assert "BroadcastHashJoin" in plan(sources.lookup_join(facts, records, "k"))
    monkeypatch.setattr("tablejobs.sources.local.BROADCAST_BYTES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(sources.lookup_join(facts, records, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_create_replace_append(spark):
    path = work_dir(spark, "t")
    sources.create_table(spark.range(3), path)
    with pytest.raises(AnalysisException):
        sources.create_table(spark.range(3), path)
    assert sources.replace_table(spark.range(5), path).count() == 5
    assert sources.append_rows(spark.range(2), path).count() == 7
    with pytest.raises(ValueError):  # never over a table that is being read
        sources.replace_table(spark.read.parquet(path).filter("id > 1"), path)
    assert spark.read.parquet(path).count() == 7


def test_a_failed_replacement_leaves_the_table(spark):
    path = work_dir(spark, "kept")
    assert sources.replace_table(spark.range(3), path).count() == 3  # none there before
    with pytest.raises(Exception, match="late row"):
        sources.replace_table(spark.range(9).selectExpr("if(id < 8, id, raise_error('late row')) AS id"), path)
    assert spark.read.parquet(path).count() == 3


def test_clustered_files_do_not_overlap(spark):
    df = spark.range(1000).selectExpr("id % 50 AS a", "id AS b")
    path = work_dir(spark, "clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one file
    try:
        assert rows(sources.clustered_write(df, path, "a", "b")) == rows(df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keyed = spark.read.parquet(path).selectExpr("input_file_name() AS f", "struct(a, b) AS k")
    spans = sorted(tuple(r) for r in keyed.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).select("lo", "hi").collect())
    assert len(spans) > 1 and all(before[1] < after[0] for before, after in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_a_shuffle(spark, plan):
    df = spark.range(1000).selectExpr("id % 50 AS a", "id AS b")
    left = sources.bucketed_write(df, "bucketed_left", work_dir(spark, "l"), 4, "a", "b")
    right = sources.bucketed_write(df, "bucketed_right", work_dir(spark, "r"), 4, "a", "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(left.join(right, "a"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_temp_table_is_visible_to_sql(spark):
    kept = sources.temp_table(spark.range(4), "four")
    assert spark.sql("SELECT count(*) FROM four").first()[0] == 4
    kept.unpersist()
