"""Silver layer: validation, the unified track table, enrichment and statistics."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Optional

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.aggregate import group_stats
from strata.constants import (
    ACOUSTIC_THRESHOLD, MIN_DURATION_MS, POPULARITY_RANGE, UNIT_RANGE,
)
from strata.operators import enrich as E
from strata.operators.quality import (
    Rule, Validated, dedup_groups_by_key, dedup_side_by_side, joint_aggs, joint_flags, joint_report, joint_rows,
    validate, validated_from,
)
from strata.operators.ranking import first_by, lag_within, large_groups, rank_by_histogram, rank_within
from strata.schemas import AUDIO_COLS, CATALOGUE_COLS, KEY
from strata.session import materialize
from strata.sinks.bucketed import Bucketed, bucket_count, deal_passes, deal_tasks, largest_bucket, write_bucketed

CATALOGUE_RULES = [
    Rule(5, "R5_min_duration", lambda: F.col("duration_ms") > MIN_DURATION_MS),
]
AUDIO_RULES = [
    Rule(3, "R3_popularity_range", lambda: F.col("popularity").between(*POPULARITY_RANGE)),
    Rule(4, "R4_unit_range", lambda: F.col("danceability").between(*UNIT_RANGE)
         & F.col("energy").between(*UNIT_RANGE)),
]
R6 = (6, "R6_key_in_catalogue")
WHOLE_NUMBERS = ("popularity",)

# A task sorts a bucket of both sources and the rows it unifies: about 750 bytes a row together.
BUCKET_ROWS = 500_000
ARTIST_BUCKET_ROWS = 1_000_000      # a task sorts a bucket of unified rows: about 430 bytes a row
UNIFY_ROWS = 1_000_000      # a task unifies buckets of the sources one by one, and sorts what comes of them

UNIFIED_COLUMNS = [KEY] + CATALOGUE_COLS + AUDIO_COLS
ENRICHED_COLUMNS = UNIFIED_COLUMNS + [
    "rank_in_genre", "pop_prev_year", "decade", "duration_sec", "popularity_category",
    "is_acoustic",
]


@dataclass(frozen=True)
class Checked:
    catalogue: Validated
    audio: Validated
    buckets: int = 1            # of the unified rows by artist (check_landed)
    tasks: Optional[int] = None     # that unify and deal them out; as many as buckets of the sources if not given


def check_sources(catalogue: DataFrame, audio: DataFrame, prepare=None) -> Checked:
    """R1..R5 on each source independently. Duplicates are resolved before the
    range rules, with the smallest row (by all non-key columns) kept per key.
    ``prepare`` (e.g. persist) is applied to each per-key frame."""
    return Checked(
        validate(catalogue, "catalogue", KEY, CATALOGUE_RULES, CATALOGUE_COLS, prepare=prepare),
        validate(audio, "audio_features", KEY, AUDIO_RULES, AUDIO_COLS, prepare=prepare),
    )


def check_split(df: DataFrame) -> Checked:
    """R1..R5 for both halves of one split frame (key + catalogue + audio columns).

    When the catalogue and audio tables are two projections of the same rows, one
    aggregate de-duplicates both halves (each half still keeps its own smallest
    row) and the halves stay side by side, so the later join disappears.
    """
    per_key = dedup_groups_by_key(df, KEY, [CATALOGUE_COLS, AUDIO_COLS])
    return Checked(
        validated_from(per_key, "catalogue", KEY, CATALOGUE_RULES, CATALOGUE_COLS),
        validated_from(per_key, "audio_features", KEY, AUDIO_RULES, AUDIO_COLS),
    )


def check_landed(catalogue: DataFrame, audio: DataFrame) -> Checked:
    """R1..R5 for two separately landed sources, side by side in one per-key frame.

    Each source is dealt out by its key once, in scratch buckets, where de-duplication and the
    join of the halves need no exchange. A source with a key (or none) that fills a
    bucket is not: its aggregate combines such a key before it shuffles.
    """
    spark, n = catalogue.sparkSession, max(catalogue.count(), audio.count())
    buckets = bucket_count(spark, n, BUCKET_ROWS)

    def dealt(df: DataFrame, sort: list[str]) -> DataFrame:
        if largest_bucket(df, KEY, buckets) > 2 * BUCKET_ROWS:
            return df
        return write_bucketed(df.coalesce(deal_tasks(spark, n)), KEY, buckets, sort, deal_passes(df, n)).table

    per_key = dedup_side_by_side(dealt(catalogue, ["artist_name", "track_name"]), dealt(audio, []), KEY,
                                 [CATALOGUE_COLS, AUDIO_COLS], ["_catalogue_n", "_audio_n"])
    return Checked(
        validated_from(per_key, "catalogue", KEY, CATALOGUE_RULES, CATALOGUE_COLS, "_catalogue_n"),
        validated_from(per_key, "audio_features", KEY, AUDIO_RULES, AUDIO_COLS, "_audio_n"),
        bucket_count(spark, n, ARTIST_BUCKET_ROWS), deal_tasks(spark, n, UNIFY_ROWS),
    )


def _passing(frame: DataFrame, checked: Checked) -> DataFrame:
    """The unified rows of a per-key frame that both halves share."""
    c, a = checked.catalogue, checked.audio
    keep = c.present() & a.present()
    for r in c.rules + a.rules:
        keep = keep & r.passes()
    return frame.filter(keep).select(*UNIFIED_COLUMNS)


def unify(checked: Checked) -> DataFrame:
    """Catalogue ⋈ audio on the key. This inner join is also rule R6 (audio rows
    without a catalogue row are dropped); keys are unique on both sides, and both
    sides arrive hash-partitioned on the key by their de-duplication. Halves that
    share one per-key frame (``check_split``, ``check_landed``) need only a filter."""
    c, a = checked.catalogue, checked.audio
    if c.per_key is a.per_key:
        return _passing(c.per_key, checked)
    return c.kept.join(a.kept, KEY, "inner").select(*UNIFIED_COLUMNS)


def write_unified(checked: Checked) -> tuple[Bucketed, DataFrame]:
    """The unified rows of ``check_landed`` in scratch buckets by artist, and the ``dq_report``,
    whose counts the same write observes: the per-key frame is worked out once. The
    write's tasks are those of a result stage, whose repeated tasks are not counted twice."""
    c, a = checked.catalogue, checked.audio
    counts = Observation("dq_report")
    observed = joint_flags(c, a).observe(counts, *joint_aggs(c, a))
    passing = _passing(observed, checked)
    passing = passing.coalesce(checked.tasks) if checked.tasks else passing
    written = write_bucketed(passing, "artist_name", checked.buckets, ["artist_name", "year", KEY])
    found = counts.get
    row = c.per_key.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{n} long" for n in found))
    return replace(written, rows=found["x_in"] - found["x_orphans"]), joint_rows(row, c, a, *R6)


def dq_report(checked: Checked) -> DataFrame:
    """Rejected rows per rule and source (R1..R6) from one aggregate, instead of a
    count before and after every rule. Two separately landed sources are first
    full-outer-joined on the key (co-partitioned, no extra shuffle); the halves of
    one split share a per-key frame and need no join."""
    return joint_report(checked.catalogue, checked.audio, *R6)


def with_scalars(df: DataFrame) -> DataFrame:
    """The per-row silver columns (no windows)."""
    return df.withColumns({
        "decade": E.decade("year"),
        "duration_sec": E.duration_sec("duration_ms"),
        "popularity_category": E.popularity_category("popularity"),
        "is_acoustic": E.at_least("acousticness", ACOUSTIC_THRESHOLD),
    })


LAG_WINDOW_MAX_ROWS = 1_000_000


def artist_rows(unified: Bucketed, max_rows: int = LAG_WINDOW_MAX_ROWS) -> DataFrame:
    """The written rows as every step by artist should read them: bucket by bucket, or file by
    file if an artist has more than ``max_rows`` rows, which no task may then hold."""
    rows = unified.files.count() if unified.rows is None else unified.rows
    if rows <= max_rows or large_groups(unified.table, ["artist_name"], max_rows).isEmpty():
        return unified.table
    return unified.files


def enrich(unified: DataFrame, *, rank_form: str = "histogram", lag_prefix: int = 3,
           lag_window_max_rows: Optional[int] = LAG_WINDOW_MAX_ROWS,
           checkpoint: bool = True) -> DataFrame:
    """Add ``rank_in_genre``, ``pop_prev_year`` and the per-row columns.

    ``rank_form='histogram'`` ranks popularity (an int in 0..100 after R3) through
    a (genre, popularity) histogram instead of sorting each genre in one task.
    ``pop_prev_year`` is the previous track of the artist ordered by
    (year, track_id), computed in (artist, year, key-prefix) blocks unless the
    largest artist has at most ``lag_window_max_rows`` rows (then one window).
    """
    df = materialize(unified) if checkpoint else unified
    df = add_lag(df, lag_prefix=lag_prefix, lag_window_max_rows=lag_window_max_rows)
    df = add_rank(df, rank_form=rank_form)
    return with_scalars(df).select(*ENRICHED_COLUMNS)


def add_lag(df: DataFrame, *, lag_prefix: int = 3,
            lag_window_max_rows: Optional[int] = LAG_WINDOW_MAX_ROWS) -> DataFrame:
    """``pop_prev_year``: popularity of the artist's previous track by (year, track_id)."""
    blocks = [F.col("year"), F.substring(KEY, 1, lag_prefix)] if lag_prefix else None
    return lag_within(df, ["artist_name"], ["year", KEY], "popularity", "pop_prev_year",
                      blocks=blocks, max_group_rows=lag_window_max_rows)


def add_rank(df: DataFrame, *, rank_form: str = "histogram") -> DataFrame:
    """``rank_in_genre``: rank by popularity (descending) within the genre."""
    if rank_form == "histogram":
        return rank_by_histogram(df, ["genre"], "popularity", name="rank_in_genre")
    if rank_form == "window":
        return rank_within(df, ["genre"], "popularity", name="rank_in_genre")
    raise ValueError(f"rank_form must be 'histogram' or 'window', got {rank_form!r}")


def genre_stats(silver: DataFrame) -> DataFrame:
    stats = group_stats(silver, ["genre", "year", "decade"],
                        averages={"popularity": 2, "tempo": 2, "energy": 4, "danceability": 4,
                                  "valence": 4},
                        count_of=KEY, count_name="nb_tracks", integers=WHOLE_NUMBERS)
    return stats.select("genre", "year", "decade", "avg_popularity", "nb_tracks", "avg_tempo",
                        "avg_energy", "avg_danceability", "avg_valence")


def artist_decade(silver: DataFrame) -> DataFrame:
    """Shared (artist, decade) aggregate behind ``artist_stats`` and the top-artists
    mart: one shuffle serves both. ``main_genre`` is the genre of the artist's
    smallest ``track_id`` in the decade (deterministic ``first``)."""
    stats = group_stats(silver, ["artist_name", "decade"], averages={"popularity": 2},
                        count_of=KEY, count_name="total_tracks", integers=WHOLE_NUMBERS,
                        extra=[F.max("popularity").alias("max_popularity"),
                               first_by("genre", F.col(KEY)).alias("main_genre")])
    return stats.select("artist_name", "decade", "total_tracks", "avg_popularity",
                        "max_popularity", "main_genre")


def artist_stats(silver: DataFrame) -> DataFrame:
    return artist_decade(silver).select("artist_name", "decade", "total_tracks",
                                        "avg_popularity", "main_genre")
