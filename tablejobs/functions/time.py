from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_type(ts: Column | str) -> Column:
    """'weekday' from Monday to Friday, else 'weekend' (Sunday is day 1)."""
    return F.when(F.dayofweek(ts).between(2, 6), "weekday").otherwise("weekend")


def hour_text(ts: Column | str) -> Column:
    return F.format_string("%02d", F.hour(ts))
