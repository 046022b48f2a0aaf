"""Vertical split of one wide source into catalogue and audio projections."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import hash_key, strip_ws
from strata.schemas import AUDIO_COLS, CATALOGUE_COLS, KEY


def _field(df: DataFrame, name: str) -> Column:
    """Stripped field; a missing column or a null (short row) reads as ''."""
    if name not in df.columns:
        return F.lit("")
    return F.coalesce(strip_ws(F.col(name)), F.lit(""))


def normalize_wide(df: DataFrame, *, artist_cols: Sequence[str] = ("artists", "artist_name"),
                   separator: str = "") -> DataFrame:
    """Strip every field, pick the first non-blank artist column, add the hash key
    and a ``_keep`` flag (name and artist both non-blank)."""
    name = _field(df, "track_name")
    artist = F.lit("")
    for c in reversed(list(artist_cols)):
        f = _field(df, c)
        artist = F.when(f != F.lit(""), f).otherwise(artist)
    out = df.select(
        name.alias("track_name"),
        artist.alias("artist_name"),
        *[_field(df, c).alias(c) for c in CATALOGUE_COLS[2:] + AUDIO_COLS],
    )
    keep = (F.col("track_name") != F.lit("")) & (F.col("artist_name") != F.lit(""))
    return out.select(
        F.when(keep, hash_key("track_name", "artist_name", separator=separator)).alias(KEY),
        "*", keep.alias("_keep"))


def split_wide(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(catalogue, audio) string projections sharing ``track_id``; blank rows dropped."""
    n = normalize_wide(df, **kw).filter(F.col("_keep"))
    return (n.select(KEY, *CATALOGUE_COLS), n.select(KEY, *AUDIO_COLS))


def split_counts(df: DataFrame, **kw) -> DataFrame:
    """One row: rows read, skipped (blank name or artist) and written."""
    n = normalize_wide(df, **kw)
    return n.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~F.col("_keep")).alias("rows_skipped"),
        F.count_if(F.col("_keep")).alias("rows_written"),
    )
