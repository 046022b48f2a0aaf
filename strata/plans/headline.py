"""Headline metrics from partial aggregates that merge.

One row for every (genre, year) of a run holds row counts, exact sums and the counts behind
them. Any selection of genres and years is answered by adding rows, rounding once at the
end, so it equals the aggregate over the tracks themselves; a landed day adds its own rows
and nothing is scanned again. Values that no exact sum holds (NaN, infinities) have a sum
of their own, which wins, as in a plain average.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import TEXT_COLLATION
from strata.functions.exact import SCALE, exact_sum, is_odd, rounded_mean
from strata.functions.predicates import in_list
from strata.sinks.runs import RunStore

TABLE = "headline_partials"
#: Averaged columns, with the fractional digits of their exact sums.
METRICS = {"popularity": 0, "tempo": SCALE}


def partials(tracks: DataFrame, by: Sequence[str] = ("genre", "year"), metrics: dict[str, int] = METRICS) -> DataFrame:
    """``n`` rows, and per metric ``s_`` (exact sum), ``c_`` (values) and ``o_`` (sum of values
    without an exact one), by the given columns."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    for c, scale in metrics.items():
        aggregates += [exact_sum(c, scale=scale, integral=not scale).alias(f"s_{c}"), F.count(c).alias(f"c_{c}")]
        if scale:
            aggregates.append(F.sum(F.when(is_odd(c), F.col(c).cast("double"))).alias(f"o_{c}"))
    return tracks.groupBy(*by).agg(*aggregates)


def merged_mean(c: str, digits: int, metrics: dict[str, int] = METRICS) -> Column:
    """Aggregate over partial rows: the average of ``c``, rounded once."""
    scale = metrics[c]
    mean = rounded_mean(F.sum(f"s_{c}"), F.sum(f"c_{c}"), digits, scale=scale)
    return F.coalesce(F.sum(f"o_{c}"), mean) if scale else mean


def add_run(store: RunStore, run: str, tracks: DataFrame) -> None:
    """The partials of a run's tracks, committed beside those of other runs; a repeated run
    replaces its own."""
    r = store.begin(run)
    r.write(partials(tracks), TABLE)
    r.commit()


def _selection(parts: DataFrame, genre_list: Sequence[str], years: tuple[int, int], collation: str) -> DataFrame:
    return parts.filter(in_list("genre", genre_list, collation) & F.col("year").between(years[0], years[1]))


def _rows() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_tracks")


def summary(parts: DataFrame, genre_list: Sequence[str], years: tuple[int, int], collation: str = TEXT_COLLATION) -> DataFrame:
    """``marts.summary`` from partial rows."""
    return _selection(parts, genre_list, years, collation).agg(
        _rows(), F.countDistinct("genre").alias("nb_genres"), merged_mean("popularity", 1).alias("avg_pop"),
        merged_mean("tempo", 1).alias("avg_tempo"))


def popularity_by_genre(parts: DataFrame, genre_list: Sequence[str], years: tuple[int, int],
                        collation: str = TEXT_COLLATION) -> DataFrame:
    """``marts.popularity_by_genre`` from partial rows."""
    return (_selection(parts, genre_list, years, collation).groupBy("genre")
            .agg(merged_mean("popularity", 2).alias("avg_popularity"), _rows())
            .orderBy(F.col("avg_popularity").desc_nulls_last(), "genre"))
