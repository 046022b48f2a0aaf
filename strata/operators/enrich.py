"""Per-row derived columns of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import CATEGORY_LABELS, HIGH_POPULARITY, MEDIUM_POPULARITY


def decade(year: str = "year") -> Column:
    """``floor(year / 10) * 10`` as int; null stays null."""
    return (F.floor(F.col(year) / F.lit(10)) * F.lit(10)).cast("int")


def duration_sec(ms: str = "duration_ms") -> Column:
    """Milliseconds to seconds (double), rounded to one decimal."""
    return F.round(F.col(ms) / F.lit(1000.0), 1)


def popularity_category(pop: str = "popularity", high: int = HIGH_POPULARITY,
                        medium: int = MEDIUM_POPULARITY, labels=CATEGORY_LABELS) -> Column:
    """``>= high`` first label, ``>= medium`` second, else (null included) third."""
    p = F.col(pop)
    return (F.when(p >= high, F.lit(labels[0])).when(p >= medium, F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))


def at_least(c: str, threshold: float) -> Column:
    """Boolean ``c >= threshold``; null -> false."""
    return F.coalesce(F.col(c) >= F.lit(threshold), F.lit(False))
