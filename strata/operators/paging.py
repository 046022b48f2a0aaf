"""Sorted pages over a DataFrame, with totals."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE


def clamp(page: Optional[int], page_size: Optional[int]) -> tuple[int, int]:
    """page >= 1; 1 <= page_size <= 200 (default 50)."""
    p = max(1, page if page is not None else 1)
    s = page_size if page_size is not None else DEFAULT_PAGE_SIZE
    return p, min(MAX_PAGE_SIZE, max(1, s))


def page(df: DataFrame, order: Sequence[Column], key: Sequence[str], page_no: Optional[int] = 1,
         page_size: Optional[int] = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Rows ``(page-1)*size .. page*size`` of ``df`` sorted by ``order`` then ``key``.

    ``key`` (a unique key) makes the order total, so consecutive pages never
    overlap. Planned as a single top-(offset+limit), not a full sort.
    """
    p, s = clamp(page_no, page_size)
    ordered = df.orderBy(*order, *[F.col(k).asc_nulls_first() for k in key])
    return ordered.offset((p - 1) * s).limit(s)


def page_meta(df: DataFrame, page_no: Optional[int] = 1,
              page_size: Optional[int] = DEFAULT_PAGE_SIZE) -> DataFrame:
    """One row: total, page, page_size, total_pages (a count, no sort)."""
    p, s = clamp(page_no, page_size)
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(p).alias("page"), F.lit(s).alias("page_size"),
        F.ceil(F.col("total") / F.lit(s)).cast("bigint").alias("total_pages"))
