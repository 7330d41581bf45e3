from tablejobs.functions.buckets import bucketize, feature_cross
from tablejobs.functions.geo import geohash
from tablejobs.functions.text import extract_or_null, has_word, underscored
from tablejobs.functions.time import day_type, hour_text

__all__ = [
    "bucketize",
    "day_type",
    "extract_or_null",
    "feature_cross",
    "geohash",
    "has_word",
    "hour_text",
    "underscored",
]
