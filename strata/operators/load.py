"""Typed loading of split string tables."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.constants import MAX_TEXT_LEN, YEAR_RANGE
from strata.functions.text import guarded_int, truncate
from strata.schemas import AUDIO, KEY


def catalogue_columns(max_len: int = MAX_TEXT_LEN) -> list[Column]:
    """The catalogue coercions as Columns (non-key fields), see ``load_catalogue``."""
    return [
        truncate("track_name", max_len).alias("track_name"),
        truncate("artist_name", max_len).alias("artist_name"),
        F.nullif(F.col("genre"), F.lit("")).alias("genre"),
        guarded_int("year", *YEAR_RANGE).alias("year"),
        guarded_int("duration_ms", dtype="bigint").alias("duration_ms"),
    ]


def load_catalogue(df: DataFrame, *, max_len: int = MAX_TEXT_LEN,
                   created_at: Optional[Column] = None) -> DataFrame:
    """Per-column coercion of a catalogue string table, as a bulk loader would do it.

    Names truncated to ``max_len``; '' genre -> null; ``year`` kept only if all
    digits in 1000..9999; ``duration_ms`` only if all digits. A trailing CR (CRLF
    files) is stripped before the digit test. ``created_at`` (load time) is added
    only when given, e.g. ``F.current_timestamp()``.
    """
    cols = [F.col(KEY)] + catalogue_columns(max_len)
    if created_at is not None:
        cols.append(created_at.alias("created_at"))
    return df.select(*cols)


def typed_columns(schema: StructType = AUDIO) -> list[Column]:
    """Permissive typed parse of each string field of ``schema`` as Columns."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() != "string":
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    return out


def parse_typed(df: DataFrame, schema: StructType = AUDIO) -> DataFrame:
    """Permissive typed parse of a string table: a field that does not parse is null
    (the semantics of a CSV read with an explicit schema)."""
    return df.select(*typed_columns(schema))
