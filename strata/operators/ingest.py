"""Raw-layer partition columns."""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Union

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import RAW_PARTITION_COLS


def parse_as_of(as_of: Union[str, _dt.date, None]) -> _dt.date:
    """``YYYY-MM-DD`` string, a date, or ``None`` for today. Bad text raises ValueError."""
    if as_of is None:
        return _dt.date.today()
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.datetime.strptime(as_of, "%Y-%m-%d").date()


def add_ingestion_partition(df: DataFrame, as_of: Union[str, _dt.date, None] = None) -> DataFrame:
    """Stamp ``ingestion_year/month/day`` (ints) for a date-partitioned landing."""
    d = parse_as_of(as_of)
    return df.withColumns({
        "ingestion_year": F.lit(d.year),
        "ingestion_month": F.lit(d.month),
        "ingestion_day": F.lit(d.day),
    })


def drop_partition_columns(df: DataFrame, cols: Optional[list[str]] = None) -> DataFrame:
    """Drop whichever raw partition columns are present."""
    present = [c for c in (cols or RAW_PARTITION_COLS) if c in df.columns]
    return df.drop(*present) if present else df
