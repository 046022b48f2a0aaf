"""Declared table schemas.

Fixed values: column names and order of the source system's catalogue and audio
tables, its raw partition columns, and the declared types of the four gold marts.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, ShortType, StringType,
    StructField, StructType,
)

KEY = "track_id"

CATALOGUE_COLS = ["track_name", "artist_name", "genre", "year", "duration_ms"]
AUDIO_COLS = [
    "danceability", "energy", "key", "loudness", "mode",
    "speechiness", "acousticness", "instrumentalness", "liveness",
    "valence", "tempo", "time_signature", "popularity",
]
RAW_PARTITION_COLS = ["ingestion_year", "ingestion_month", "ingestion_day"]

_INT_AUDIO = {"key", "mode", "time_signature", "popularity"}

CATALOGUE = StructType(
    [StructField(KEY, StringType())]
    + [StructField(c, StringType()) for c in ("track_name", "artist_name", "genre")]
    + [StructField("year", IntegerType()), StructField("duration_ms", LongType())]
)

AUDIO = StructType(
    [StructField(KEY, StringType())]
    + [StructField(c, IntegerType() if c in _INT_AUDIO else DoubleType()) for c in AUDIO_COLS]
)


# The wide source with the catalogue and audio types applied.
WIDE_TYPED = StructType(
    [StructField(c, StringType()) for c in ("track_name", "artist_name", "genre")]
    + [StructField("year", IntegerType()), StructField("duration_ms", LongType())]
    + AUDIO.fields[1:]
)


def all_strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


# Gold marts as declared by the serving database (keys listed separately).
GOLD_TRACKS = StructType([
    StructField("track_id", StringType(), False),
    StructField("track_name", StringType()),
    StructField("artist_name", StringType()),
    StructField("genre", StringType()),
    StructField("year", ShortType()),
    StructField("popularity", ShortType()),
    StructField("danceability", _dec(6, 4)),
    StructField("energy", _dec(6, 4)),
    StructField("valence", _dec(6, 4)),
    StructField("tempo", _dec(8, 2)),
    StructField("acousticness", _dec(6, 4)),
    StructField("instrumentalness", _dec(6, 4)),
    StructField("duration_ms", LongType()),
    StructField("rank_in_genre", IntegerType()),
    StructField("popularity_category", StringType()),
    StructField("ingestion_date", DateType()),
])
GOLD_TRENDS = StructType([
    StructField("genre", StringType(), False),
    StructField("decade", ShortType(), False),
    StructField("avg_popularity", _dec(6, 2)),
    StructField("nb_tracks", IntegerType()),
    StructField("avg_danceability", _dec(6, 4)),
    StructField("avg_energy", _dec(6, 4)),
    StructField("top_track_name", StringType()),
    StructField("ingestion_date", DateType()),
])
GOLD_ARTISTS = StructType([
    StructField("artist_name", StringType(), False),
    StructField("decade", ShortType(), False),
    StructField("total_tracks", IntegerType()),
    StructField("avg_popularity", _dec(6, 2)),
    StructField("max_popularity", _dec(6, 2)),
    StructField("main_genre", StringType()),
    StructField("influence_score", _dec(10, 2)),
    StructField("rank_in_decade", IntegerType()),
    StructField("ingestion_date", DateType()),
])
GOLD_HITS = StructType([
    StructField("genre", StringType(), False),
    StructField("year", ShortType(), False),
    StructField("track_id", StringType(), False),
    StructField("track_name", StringType()),
    StructField("artist_name", StringType()),
    StructField("popularity", ShortType()),
    StructField("danceability", _dec(6, 4)),
    StructField("energy", _dec(6, 4)),
    StructField("valence", _dec(6, 4)),
    StructField("tempo", _dec(8, 2)),
    StructField("rank_in_year", IntegerType()),
    StructField("ingestion_date", DateType()),
])

GOLD_KEYS = {
    "dm_track_popularity": ["track_id"],
    "dm_genre_trends": ["genre", "decade"],
    "dm_top_artists": ["artist_name", "decade"],
    "dm_hits_emergents": ["genre", "year", "track_id"],
}
# Declared lengths of the marts' text columns, in characters.
GOLD_TEXT_LENGTHS = {
    "track_id": 16, "track_name": 500, "artist_name": 500, "top_track_name": 500, "genre": 100, "main_genre": 100,
    "popularity_category": 10,
}
GOLD_SCHEMAS = {
    "dm_track_popularity": GOLD_TRACKS,
    "dm_genre_trends": GOLD_TRENDS,
    "dm_top_artists": GOLD_ARTISTS,
    "dm_hits_emergents": GOLD_HITS,
}
