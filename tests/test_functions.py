import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from tablejobs.functions import bucketize, day_type, extract_or_null, feature_cross, geohash, has_word, hour_text, underscored


def test_geohash_of_known_places(spark):
    places = [("u4pruy", 10.40744, 57.64911), ("gcpuvr", -0.12, 51.5), ("zzzzzz", 180.0, 90.0), ("000000", -180.0, -90.0)]
    df = spark.createDataFrame(places, "expected string, lon double, lat double")
    for length in (1, 2, 4, 6):
        found = df.select("expected", geohash("lon", "lat", length)).collect()
        assert all(r[0][:length] == r[1] for r in found)


def test_bucketize_as_the_ml_stage_does(spark):
    df = spark.createDataFrame([(float(h),) for h in range(24)], "h double")
    stage = Bucketizer(splits=[float("-inf"), 5.0, 10.0, 17.0, float("inf")], inputCol="h", outputCol="b")
    found = stage.transform(df).select("b", bucketize("h", [17, 5, 10])).collect()
    assert all(int(a) == b for a, b in found)
    assert spark.createDataFrame([(None,)], "h double").select(bucketize("h", [1])).first()[0] is None


def test_cross_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    assert [r[0] for r in df.select(feature_cross("x", "y")).collect()] == ["a_1", None]


def test_text(spark):
    df = spark.createDataFrame([("Diapers Size 2",), ("Wipes",), (None,)], "t string")
    found = df.select(extract_or_null(F.lower("t"), "size ([0-9])"), has_word("t", "wipes"), underscored("t")).collect()
    assert [tuple(r) for r in found] == [("2", 0, "Diapers_Size_2"), (None, 1, "Wipes"), (None, 0, None)]


@pytest.mark.parametrize("day, kind", [("2024-01-05", "weekday"), ("2024-01-06", "weekend"), ("2024-01-07", "weekend"), ("2024-01-08", "weekday")])
def test_day_type(spark, day, kind):
    df = spark.sql(f"SELECT timestamp '{day} 07:30:00' AS ts")
    assert tuple(df.select(day_type("ts"), hour_text("ts")).first()) == (kind, "07")


def test_points_without_or_beyond_coordinates(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "lon double, lat double")
    assert [r[0] for r in df.select(geohash("lon", "lat", 6)).collect()] == [None, None]
    with pytest.raises(Exception, match="no such coordinate"):
        spark.createDataFrame([(0.0, 95.0)], "lon double, lat double").select(geohash("lon", "lat", 6)).collect()
