"""Segments of users by the class they fall into for each product group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablejobs.models.clustering import Segments, select_segments
from tablejobs.models.metrics import segment_profile
from tablejobs.operators import hash_sample

SAMPLE = 10_000


def segmentation(
    classes: DataFrame, measures: Sequence[str], ks: Sequence[int] = (3, 4, 5), sample: int = SAMPLE, seed: int = 0
) -> tuple[Segments, DataFrame]:
    """Fit on a sample of users, keep the best k, assign all users: (segments, assigned)."""
    best, _ = select_segments(hash_sample(classes, "user_id", sample, str(seed)), measures, ks, seed)
    return best, best.assign(classes)


def profile(assigned: DataFrame, measures: Sequence[str]) -> DataFrame:
    return segment_profile(assigned, measures)
