"""Helpers shared by the corpus operators: tables, text expressions, prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six ASCII white-space characters that separate words.
SPACE_CLASS = r"[\x20\x09-\x0D]"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit(""))


def words(text: str | Column) -> Column:
    """Words: maximal runs of anything but ASCII white space; null gives no word."""
    return F.array_remove(F.split(text_or_empty(text), SPACE_CLASS + "+"), "")


def n_words(text: str | Column) -> Column:
    """Number of words, without building them."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ascii_lower(text: str | Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast built-in."""
    c = text_or_empty(text)
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, ASCII_UPPER, ASCII_UPPER.lower()))


def utf8_bytes(text: str | Column) -> Column:
    return F.octet_length(text_or_empty(text)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, prefixed with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
