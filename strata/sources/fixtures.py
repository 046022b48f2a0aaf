"""F-SRC: the music source shape derived from the driver's TPC-H-like tables.

One source row per line item: ``lineitem ⋈ part ⋈ supplier``. The mapping below is
fixed (see FIXTURES.md) so an independent SQL engine can rebuild the same rows.
The wide source is returned as all strings, like a header CSV read without a schema.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import AUDIO_COLS, CATALOGUE_COLS
from strata.sources.files import spread


_READS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The driver tables are read-only, so the (lazy) reader is
    reused per session instead of listing files and reading footers per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _READS.get(path)
    if hit is None or hit[0] is not spark:
        hit = _READS[path] = (spark, spark.read.parquet(path))
    return hit[1]


def _dec(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(6,4)")


def _lit_dec(v: str) -> Column:
    return F.lit(Decimal(v))


def typed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed source rows (before the string round trip)."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_shipdate"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Dimension joins: Catalyst broadcasts a side only when its scanned size is under
    # spark.sql.autoBroadcastJoinThreshold (a checked bound); otherwise sort-merge.
    src = (li.join(part, li.l_partkey == part.p_partkey)
             .join(sup, li.l_suppkey == sup.s_suppkey))
    q = F.col("l_quantity")
    return src.select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("l_partkey").cast("string")).alias("track_name"),
        F.col("s_name").alias("artist_name"),
        F.col("p_type").alias("genre"),
        F.year("l_shipdate").alias("year"),
        (q * 10000).cast("int").alias("duration_ms"),
        (_dec("l_discount") * _lit_dec("10.5")).cast("double").alias("danceability"),
        (_dec("l_tax") * _lit_dec("12.5")).cast("double").alias("energy"),
        (F.col("l_partkey") % 12).cast("int").alias("key"),
        (-q).alias("loudness"),
        (F.col("l_partkey") % 2).cast("int").alias("mode"),
        (_dec("l_linenumber") * _lit_dec("0.1")).cast("double").alias("speechiness"),
        (_dec("l_discount") * _lit_dec("10")).cast("double").alias("acousticness"),
        (_dec("l_tax") * _lit_dec("10")).cast("double").alias("instrumentalness"),
        (_dec("l_linenumber") * _lit_dec("0.125")).cast("double").alias("liveness"),
        (_dec(F.col("l_linenumber") - 1) * _lit_dec("0.15")).cast("double").alias("valence"),
        (F.lit(60.0) + F.lit(2.0) * q).alias("tempo"),
        (F.lit(3) + F.col("l_linenumber") % 3).cast("int").alias("time_signature"),
        F.floor(F.col("l_extendedprice") / F.lit(1000.0)).cast("int").alias("popularity"),
    )


def damaged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide source with blank or white names and artists, null genres and years."""
    src = wide_source(spark, sf_dir)
    hour = F.col("speechiness")          # 0.1 .. 0.7, a tenth of the line number
    return src.withColumns({
        "track_name": F.when(hour == "0.7", F.lit(" \t")).otherwise(F.col("track_name")),
        "artist_name": F.when(hour == "0.6", F.lit("")).otherwise(F.col("artist_name")),
        "genre": F.when(hour != "0.5", F.col("genre")),
        "year": F.when(hour != "0.4", F.col("year"))})


def damaged_keys(df: DataFrame) -> DataFrame:
    """A raw table in which keys that begin with 0 are blank and with 1 are null."""
    head = F.substring("track_id", 1, 1)
    return df.withColumn("track_id", F.when(head == "0", F.lit("")).when(head != "1", F.col("track_id")))


def wide_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide source as a header CSV would give it: every column a string."""
    src = typed_source(spark, sf_dir)
    return src.select([F.col(c).cast("string").alias(c) for c in CATALOGUE_COLS + AUDIO_COLS])
