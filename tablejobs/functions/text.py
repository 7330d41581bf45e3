from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_or_null(text: Column | str, pattern: str) -> Column:
    """First group of the first match; null where nothing matches (Spark's own function gives an empty string)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def has_word(text: Column | str, word: str) -> Column:
    """1 where the lower-cased text contains ``word``, else 0."""
    return F.when(F.contains(F.lower(text), F.lit(word)), 1).otherwise(0)


def underscored(text: Column | str) -> Column:
    """Blanks as underscores, so that a value can name a column."""
    return F.replace(F.col(text) if isinstance(text, str) else text, F.lit(" "), F.lit("_"))
