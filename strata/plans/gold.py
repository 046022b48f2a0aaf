"""Gold marts built from the silver track table."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Union

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import HITS_PER_GROUP
from strata.functions.exact import round_half_up
from strata.operators.aggregate import best_by, group_stats
from strata.operators.conform import conform
from strata.operators.ingest import parse_as_of
from strata.operators.ranking import rank_by_histogram, top_n
from strata.plans.silver import WHOLE_NUMBERS, artist_decade
from strata.schemas import GOLD_SCHEMAS, GOLD_TEXT_LENGTHS, KEY
from strata.session import materialize
from strata.sinks.clustered import ClusteredTable, write_clustered

AsOf = Union[str, _dt.date, None]

TRACK_COLUMNS = [
    "track_id", "track_name", "artist_name", "genre", "year", "popularity", "danceability",
    "energy", "valence", "tempo", "acousticness", "instrumentalness", "duration_ms",
    "rank_in_genre", "popularity_category",
]
HIT_COLUMNS = [
    "genre", "year", "track_id", "track_name", "artist_name", "popularity", "danceability",
    "energy", "valence", "tempo", "rank_in_year",
]


def _stamp(df: DataFrame, as_of: AsOf) -> DataFrame:
    return df.withColumn("ingestion_date", F.lit(parse_as_of(as_of).isoformat()).cast("date"))


def dm_tracks(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """DM1: one row per track with its features and rank in genre."""
    return _stamp(silver.select(*TRACK_COLUMNS), as_of)


def dm_genre_trends(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """DM2: (genre, decade) averages plus the most popular track, in one aggregate.

    The top track is the highest popularity, then the smallest ``track_id``; a group
    whose genre or decade is null gets no top track (the null keys never matched
    in the two-pass form this replaces).
    """
    agg = group_stats(silver, ["genre", "decade"],
                      averages={"popularity": 2, "danceability": 4, "energy": 4},
                      count_of=KEY, count_name="nb_tracks", integers=WHOLE_NUMBERS,
                      extra=[best_by("track_name", "popularity", tie_break=[KEY]).alias("_top")])
    named = F.when(F.col("genre").isNotNull() & F.col("decade").isNotNull(), F.col("_top"))
    out = agg.withColumn("top_track_name", named).select(
        "genre", "decade", "avg_popularity", "nb_tracks", "avg_danceability", "avg_energy",
        "top_track_name")
    return _stamp(out, as_of)


def dm_top_artists(silver: DataFrame, as_of: AsOf = None, *, checkpoint: bool = True) -> DataFrame:
    """DM3: (artist, decade) stats, influence score and rank in decade.

    ``influence_score = round(avg_popularity * ln(1 + total_tracks), 2)`` on the
    already rounded average. The rank is taken through a (decade, score) histogram:
    scores are 2-decimal numbers in a bounded range, so the histogram stays small
    however many artists a decade has.
    """
    agg = artist_decade(silver).withColumn(
        "influence_score",
        round_half_up(F.col("avg_popularity") * F.log1p(F.col("total_tracks").cast("double")), 2))
    if checkpoint:
        agg = materialize(agg)
    ranked = rank_by_histogram(agg, ["decade"], "influence_score", name="rank_in_decade")
    return _stamp(ranked.select("artist_name", "decade", "total_tracks", "avg_popularity",
                                "max_popularity", "main_genre", "influence_score",
                                "rank_in_decade"), as_of)


def dm_hits(silver: DataFrame, as_of: AsOf = None, n: int = HITS_PER_GROUP, *,
            method: str = "histogram") -> DataFrame:
    """DM4: tracks with ``rank() <= n`` by popularity per (genre, year); ties kept.

    Popularity has 101 values, so a large (genre, year) has huge ties at the top;
    the histogram form keeps them without ever sorting a group in one task.
    """
    hits = top_n(silver, ["genre", "year"], "popularity", n, name="rank_in_year", method=method)
    return _stamp(hits.select(*HIT_COLUMNS), as_of)


# The order each table is presented in (sinks do not keep row order, so it is
# applied when reading): column, descending?
BUILD_ORDER = {
    "genre_stats": [("genre", False), ("year", False)],
    "artist_stats": [("decade", False), ("avg_popularity", True)],
    "dm_genre_trends": [("genre", False), ("decade", False)],
    "dm_top_artists": [("decade", False), ("rank_in_decade", False)],
    "dm_hits_emergents": [("genre", False), ("year", False), ("rank_in_year", False)],
}


@dataclass(frozen=True)
class Clustering:
    """A clustered copy of a mart: its order, its unique key, and the declared indexes it serves."""
    order: tuple[tuple[str, bool], ...]
    key: tuple[str, ...]
    indexes: tuple[str, ...] = ()
    facets: tuple[str, ...] = ()


# The declared indexes of the marts (primary keys aside), as clustered copies: the first of
# each mart stands in the order of its list, so its pages are found by offset.
CLUSTERINGS: dict[str, dict[str, Clustering]] = {
    "dm_track_popularity": {
        "idx_popularity": Clustering((("popularity", True),), ("track_id",), ("popularity", "rank_in_genre")),
        "idx_genre": Clustering((("genre", False), ("popularity", True)), ("track_id",), ("genre", "popularity", "rank_in_genre"),
                                ("genre",)),
        "idx_artist": Clustering((("artist_name", False), ("popularity", True)), ("track_id",), ("artist_name", "popularity")),
        "idx_rank": Clustering((("rank_in_genre", False),), ("track_id",), ("rank_in_genre", "popularity")),
    },
    "dm_genre_trends": {
        "idx_decade": Clustering((("decade", False), ("avg_popularity", True)), ("genre",), ("decade",), ("decade", "genre")),
    },
    "dm_top_artists": {
        "idx_decade": Clustering((("decade", False), ("rank_in_decade", False)), ("artist_name",), ("decade", "rank_in_decade"),
                                 ("decade",)),
        "idx_rank": Clustering((("rank_in_decade", False),), ("artist_name", "decade"), ("rank_in_decade",), ("decade",)),
    },
    "dm_hits_emergents": {
        "idx_year": Clustering((("year", True), ("rank_in_year", False)), ("genre", "track_id"), ("year",), ("year", "genre")),
        "idx_genre": Clustering((("genre", False), ("year", True), ("rank_in_year", False)), ("track_id",), ("genre", "year"),
                                ("genre",)),
    },
}


def write_clusterings(mart: DataFrame, name: str, root: str, **options) -> dict[str, ClusteredTable]:
    """Every clustered copy of a written mart, under ``root/name/index``."""
    return {index: write_clustered(mart, f"{root.rstrip('/')}/{name}/{index}", c.order, c.key, indexes=c.indexes,
                                   facets=c.facets, written=True, **options)
            for index, c in CLUSTERINGS[name].items()}


def in_build_order(df: DataFrame, name: str) -> DataFrame:
    """Sort a table as its builder presents it (nulls first ascending, last
    descending), for display or export; not needed before a sink."""
    cols = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in BUILD_ORDER[name]]
    return df.orderBy(*cols)


def typed(mart: DataFrame, name: str) -> DataFrame:
    """Cast a mart to the serving database's declared column types and text lengths."""
    return conform(mart, GOLD_SCHEMAS[name], lengths=GOLD_TEXT_LENGTHS)
