"""Preprocessing that is stored with the model and replayed on raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import FeatureHasher, Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.functions import bucketize, day_type, feature_cross, geohash, hour_text

HOUR_SPLITS = (5, 10, 17)
HASH_PLACES = 1 << 18  # places for the values of hashed columns


def trip_columns(version: str) -> dict[str, Column]:
    """The four feature versions of the hire models, as named columns over raw hires (``geo`` needs the station's place)."""
    hour_bin = bucketize(F.hour("start_date"), HOUR_SPLITS)
    if version == "plain":
        return {
            "station": F.col("start_station_name"),
            "dayofweek": day_type("start_date"),
            "hourofday": hour_text("start_date"),
        }
    if version == "transform":
        return {
            "station": F.col("start_station_name"),
            "dayofweek": F.dayofweek("start_date").cast("string"),
            "hourofday": F.hour("start_date").cast("string"),
        }
    if version == "bucketized":
        return {
            "station": F.col("start_station_name"),
            "dayofweek": day_type("start_date"),
            "hourofday": hour_bin.cast("string"),
        }
    if version == "geo":
        place = geohash("longitude", "latitude", 6)
        return {
            "dayhr": feature_cross(day_type("start_date"), hour_bin),
            "start_station_loc2": F.substring(place, 1, 2),
            "start_station_loc4": F.substring(place, 1, 4),
            "start_station_loc6": place,
        }
    raise ValueError(f"unknown feature version {version}")


class TripFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the columns of one feature version; as a pipeline stage it is saved with the model and replayed by it."""

    version = Param(Params._dummy(), "version", "feature version", typeConverter=TypeConverters.toString)

    def __init__(self, version: str | None = None):
        super().__init__()
        self._setDefault(version="plain")
        if version is not None:
            self._set(version=version)

    def columns(self) -> dict[str, Column]:
        return trip_columns(self.getOrDefault(self.version))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select("*", *[c.alias(n) for n, c in self.columns().items()])


def encoding(categorical: Sequence[str], numeric: Sequence[str], hashed: Sequence[str] = ()) -> list[Estimator | Transformer]:
    """Stages that turn the columns into one ``features`` vector.

    Categories are one-hot encoded, with a place for values not seen in training. Their lists pass through the driver, so the
    caller names as ``hashed`` those of the categorical columns that have too many values for that: they are hashed to
    HASH_PLACES places, without names for their weights. The number of values changes nothing. Missing numbers take the mean.
    """
    if unknown := set(hashed) - set(categorical):
        raise ValueError(f"not among the categorical columns: {sorted(unknown)}")
    stages: list[Estimator | Transformer] = []
    inputs: list[str] = []
    listed = [c for c in categorical if c not in hashed]
    if listed:
        index, onehot = [f"{c}_ix" for c in listed], [f"{c}_oh" for c in listed]
        stages.append(StringIndexer(inputCols=listed, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=False))
        inputs += onehot
    if hashed:
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol="hashed", numFeatures=HASH_PLACES))
        inputs.append("hashed")
    if numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages.append(Imputer(inputCols=list(numeric), outputCols=filled, strategy="mean"))
        inputs += filled
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages
