"""Building blocks for optional filters on marts."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Optional

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(*conditions: Optional[Column]) -> Optional[Column]:
    """AND of the supplied conditions; ``None`` entries mean "not given".

    Returns ``None`` when nothing was supplied, i.e. no WHERE clause at all.
    """
    given = [c for c in conditions if c is not None]
    if not given:
        return None
    return reduce(lambda a, b: a & b, given)


def contains_text(c: str | Column, text: str, collation: str = "UTF8_BINARY") -> Column:
    """Substring test with the text taken literally (``%`` and ``_`` are plain chars).

    ``collation='UNICODE_CI_AI'`` gives a case- and accent-insensitive match like a
    default utf8mb4 RDBMS collation.
    """
    col = F.col(c) if isinstance(c, str) else c
    if collation != "UTF8_BINARY":
        col = F.collate(col, collation)
    return F.contains(col, F.lit(text))


def equals_text(c: str | Column, value: str, collation: str = "UTF8_BINARY") -> Column:
    """String equality under ``collation`` (binary by default)."""
    col = F.col(c) if isinstance(c, str) else c
    if collation != "UTF8_BINARY":
        col = F.collate(col, collation)
    return col == F.lit(value)


def in_list(c: str | Column, values: Iterable, collation: str = "UTF8_BINARY") -> Column:
    """``c IN (values)`` under ``collation``; an empty list matches nothing."""
    vals = list(values)
    col = F.col(c) if isinstance(c, str) else c
    if not vals:
        return F.lit(False)
    if collation != "UTF8_BINARY":
        col = F.collate(col, collation)
    return col.isin(vals)
