"""Serving queries over the gold marts: filtered, sorted, paged DataFrames.

``None`` means "filter not given"; ``0`` and ``''`` are real values.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import (
    DEFAULT_YEAR_RANGE, EVOLUTION_MAX_GENRES, RAW_TRACKS_SHOWN, TEXT_COLLATION, TOP_HITS_SHOWN,
)
from strata.functions.exact import exact_avg
from strata.functions.predicates import all_of, contains_text, equals_text, in_list
from strata.operators.paging import page, page_meta
from strata.session import materialize



def _where(df: DataFrame, *conds) -> DataFrame:
    cond = all_of(*conds)
    return df if cond is None else df.filter(cond)


def _eq(c: str, v):
    return None if v is None else (F.col(c) == F.lit(v))


def _eq_text(c: str, v: Optional[str], collation: str):
    return None if v is None else equals_text(c, v, collation)


def tracks_filter(dm: DataFrame, *, artist: Optional[str] = None, genre: Optional[str] = None,
                  year: Optional[int] = None, min_popularity: Optional[int] = None,
                  max_rank: Optional[int] = None, collation: str = TEXT_COLLATION) -> DataFrame:
    """Optional filters of the track list; text filters use ``collation``
    (case- and accent-insensitive by default), the artist text is taken literally."""
    return _where(
        dm,
        None if artist is None else contains_text("artist_name", artist, collation),
        _eq_text("genre", genre, collation), _eq("year", year),
        None if min_popularity is None else F.col("popularity") >= min_popularity,
        None if max_rank is None else F.col("rank_in_genre") <= max_rank,
    )


def tracks(dm: DataFrame, *, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    """Track mart page, most popular first."""
    return page(tracks_filter(dm, **filters), [F.col("popularity").desc_nulls_last()],
                ["track_id"], page_no, page_size)


def tracks_page_ranked(rows: DataFrame, *, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    """The page that ``tracks`` gives, from written mart rows without ``rank_in_genre``: the page
    is cut first, and only its (genre, popularity) pairs, one page of them at most, are
    ranked, by counting the rows of their genres that are more popular."""
    shown = materialize(tracks(rows, page_no=page_no, page_size=page_size, **filters))
    pairs = F.broadcast(shown.select(F.col("genre").alias("_g"), F.col("popularity").alias("_p")).distinct())
    levels = rows.groupBy("genre", "popularity").agg(F.count(F.lit(1)).alias("_n"))
    above = (F.col("popularity") > F.col("_p")) | (F.col("_p").isNull() & F.col("popularity").isNotNull())
    ranks = (levels.join(pairs, F.col("genre").eqNullSafe(F.col("_g"))).groupBy("_g", "_p")
             .agg((F.coalesce(F.sum(F.when(above, F.col("_n"))), F.lit(0)) + 1).alias("rank_in_genre")))
    same = F.col("genre").eqNullSafe(F.col("_g")) & F.col("popularity").eqNullSafe(F.col("_p"))
    return (shown.join(ranks, same).drop("_g", "_p")
            .orderBy(F.col("popularity").desc_nulls_last(), F.col("track_id").asc_nulls_first()))


def tracks_meta(dm: DataFrame, *, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    return page_meta(tracks_filter(dm, **filters), page_no, page_size)


def genre_trends(dm: DataFrame, *, genre: Optional[str] = None, decade: Optional[int] = None,
                 page_no: int = 1, page_size: int = 50,
                 collation: str = TEXT_COLLATION) -> DataFrame:
    df = _where(dm, _eq_text("genre", genre, collation), _eq("decade", decade))
    return page(df, [F.col("decade").asc_nulls_first(), F.col("avg_popularity").desc_nulls_last()],
                ["genre"], page_no, page_size)


def top_artists(dm: DataFrame, *, decade: Optional[int] = None, genre: Optional[str] = None,
                max_rank: Optional[int] = None, page_no: int = 1, page_size: int = 50,
                collation: str = TEXT_COLLATION) -> DataFrame:
    df = _where(dm, _eq("decade", decade), _eq_text("main_genre", genre, collation),
                None if max_rank is None else F.col("rank_in_decade") <= max_rank)
    return page(df, [F.col("decade").asc_nulls_first(), F.col("rank_in_decade").asc_nulls_first()],
                ["artist_name"], page_no, page_size)


def hits(dm: DataFrame, *, genre: Optional[str] = None, year: Optional[int] = None,
         page_no: int = 1, page_size: int = 50, collation: str = TEXT_COLLATION) -> DataFrame:
    df = _where(dm, _eq_text("genre", genre, collation), _eq("year", year))
    return page(df, [F.col("year").desc_nulls_last(), F.col("rank_in_year").asc_nulls_first()],
                ["genre", "track_id"], page_no, page_size)


def genres(dm_tracks: DataFrame) -> DataFrame:
    """Genres in the data, in order."""
    return dm_tracks.filter(F.col("genre").isNotNull()).select("genre").distinct().orderBy("genre")


def decades(dm_trends: DataFrame) -> DataFrame:
    """Decades in the data, in order."""
    return dm_trends.filter(F.col("decade").isNotNull()).select("decade").distinct().orderBy("decade")


def year_range(dm_tracks: DataFrame, default: tuple[int, int] = DEFAULT_YEAR_RANGE) -> DataFrame:
    """One row (y_min, y_max); the default pair when there is no year at all."""
    mn, mx = F.min("year"), F.max("year")
    return dm_tracks.agg(
        F.when(mn.isNull(), F.lit(default[0])).otherwise(mn).cast("int").alias("y_min"),
        F.when(mn.isNull(), F.lit(default[1])).otherwise(mx).cast("int").alias("y_max"))


def _selection(dm: DataFrame, genre_list: Sequence[str], years: tuple[int, int],
               collation: str = TEXT_COLLATION) -> DataFrame:
    return dm.filter(in_list("genre", genre_list, collation)
                     & F.col("year").between(years[0], years[1]))


def summary(dm_tracks: DataFrame, genre_list: Sequence[str], years: tuple[int, int]) -> DataFrame:
    """Headline metrics of a selection (one row)."""
    s = _selection(dm_tracks, genre_list, years)
    return s.agg(
        F.count(F.lit(1)).alias("total_tracks"),
        F.countDistinct("genre").alias("nb_genres"),
        exact_avg("popularity", 1, integral=True).alias("avg_pop"),
        exact_avg("tempo", 1).alias("avg_tempo"),
    )


def popularity_by_genre(dm_tracks: DataFrame, genre_list: Sequence[str],
                        years: tuple[int, int]) -> DataFrame:
    s = _selection(dm_tracks, genre_list, years)
    return (s.groupBy("genre")
             .agg(exact_avg("popularity", 2, integral=True).alias("avg_popularity"),
                  F.count(F.lit(1)).alias("total_tracks"))
             .orderBy(F.col("avg_popularity").desc_nulls_last(), "genre"))


def evolution(dm_trends: DataFrame, genre_list: Sequence[str]) -> DataFrame:
    """Genre x decade series for at most the first five selected genres."""
    chosen = list(genre_list)[:EVOLUTION_MAX_GENRES]
    return (dm_trends.filter(in_list("genre", chosen, TEXT_COLLATION))
            .select("genre", "decade", "avg_popularity", "avg_danceability", "avg_energy",
                    "nb_tracks")
            .orderBy("genre", "decade"))


def top_artists_of(dm_artists: DataFrame, decade: int, n: int) -> DataFrame:
    return (dm_artists.filter(F.col("decade") == decade)
            .select("artist_name", "avg_popularity", "total_tracks", "influence_score",
                    "rank_in_decade", "main_genre")
            .orderBy("rank_in_decade", "artist_name").limit(n))


def most_influential(dm_artists: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (artist, decade) rows by influence score over all decades."""
    return (dm_artists.select("artist_name", "decade", "influence_score", "rank_in_decade")
            .orderBy(F.col("influence_score").desc_nulls_last(), "artist_name", "decade")
            .limit(n))


def hits_of(dm_hits: DataFrame, genre: str, year: int, n: int = TOP_HITS_SHOWN) -> DataFrame:
    return (dm_hits.filter(equals_text("genre", genre, TEXT_COLLATION) & (F.col("year") == year))
            .select("track_name", "artist_name", "popularity", "danceability", "energy",
                    "valence", "tempo", "rank_in_year", "track_id")
            .orderBy("rank_in_year", "track_id").limit(n))


def top_tracks(dm_tracks: DataFrame, genre_list: Sequence[str], years: tuple[int, int],
               n: int = RAW_TRACKS_SHOWN) -> DataFrame:
    return (_selection(dm_tracks, genre_list, years)
            .select("track_id", "track_name", "artist_name", "genre", "year", "popularity",
                    "danceability", "energy", "valence", "tempo", "popularity_category",
                    "rank_in_genre")
            .orderBy(F.col("popularity").desc_nulls_last(), "track_id").limit(n))
