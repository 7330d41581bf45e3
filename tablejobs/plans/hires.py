"""Bike hires (start_station_name, start_station_id, duration, start_date) and stations (id, latitude, longitude)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.functions import geohash
from tablejobs.operators import hash_fraction, top_names


def after_date(hires: DataFrame, day: str) -> DataFrame:
    """Hires of the days after ``day``; reaches the scan as a comparison on the timestamp itself."""
    return hires.filter(F.to_date("start_date") > F.lit(day).cast("date"))


def since(hires: DataFrame, moment: str) -> DataFrame:
    return hires.filter(F.col("start_date") > F.lit(moment).cast(hires.schema["start_date"].dataType))


def hires_by_top_stations(hires: DataFrame, moment: str, k: int = 3) -> DataFrame:
    """The k busiest stations by name, and their hires. The list is at most k names, so it can be broadcast."""
    recent = since(hires, moment)
    top = F.broadcast(top_names(recent, "start_station_name", k).select("start_station_name"))
    kept = recent.join(top, "start_station_name", "left_semi")
    return kept.groupBy("start_station_name").agg(F.count(F.lit(1)).alias("nb_hires"))


def top_station_array(hires: DataFrame, moment: str, k: int = 3) -> DataFrame:
    """The same k names as one array, busiest first."""
    top = top_names(since(hires, moment), "start_station_name", k)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "start_station_name")))
    return top.agg(F.transform(ranked, lambda s: s["start_station_name"]).alias("top_stations"))


def exact_mean(column: str) -> Column:
    """Mean over a decimal sum (six places): the same whatever order the rows are added in."""
    return F.sum(F.col(column).cast("decimal(28,6)")).cast("double") / F.count(column)


def avg_duration(hires: DataFrame, names: Sequence[str], moment: str) -> DataFrame:
    """Mean duration at the listed stations (upper case) after a moment."""
    listed = since(hires, moment).filter(F.upper("start_station_name").isin(list(names)))
    return listed.groupBy("start_station_name").agg(exact_mean("duration").alias("avg_duration"))


def trip_type(limit: float) -> Column:
    return F.when(F.col("duration") > limit, "long").otherwise("court")


def trip_type_rate(hires: DataFrame, limit: float, key: str, fraction: float, seed: str = "") -> DataFrame:
    """Hires by trip type over a reproducible sample."""
    sampled = hash_fraction(hires, key, fraction, seed).select(trip_type(limit).alias("type_trajet"))
    return sampled.groupBy("type_trajet").agg(F.count(F.lit(1)).alias("n"))


def with_station(hires: DataFrame, stations: DataFrame) -> DataFrame:
    place = stations.select(F.col("id").alias("start_station_id"), "latitude", "longitude")
    return hires.join(place, "start_station_id")


def geo_cell_rollup(hires: DataFrame, stations: DataFrame, lengths: Sequence[int] = (6, 4, 2)) -> DataFrame:
    """Hires and mean duration per geohash cell, for cells of several sizes.

    Hires are added up per station before they meet its place, and the wider cells are added up from the narrowest.
    """
    per_station = hires.groupBy("start_station_id").agg(
        F.count("duration").alias("n"), F.sum(F.col("duration").cast("decimal(28,6)")).alias("total")
    )
    placed = with_station(per_station, stations).withColumn("cell", geohash("longitude", "latitude", max(lengths)))
    narrow = placed.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    prefixes = F.explode(F.array(*[F.substring("cell", 1, n) for n in lengths]))
    sums = narrow.withColumn("cell", prefixes).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return sums.select(
        "cell", F.col("n").alias("nb_hires"), (F.col("total").cast("double") / F.col("n")).alias("avg_duration")
    )
