"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written from the semantics, not generated from the Spark plans: window functions
where the library uses histograms or blocks, ``row_number`` where it uses
``min(struct)`` / ``min_by``, plain joins where it fuses aggregates, and whole-number
arithmetic where it averages in decimals.
"""

from __future__ import annotations

from strata.functions.text import PY_WHITESPACE
from strata.registry import (
    ALL_GENRES, AS_OF, DAY_1, DAY_2, EVOLUTION_GENRES, SEL_GENRES, SEL_YEARS,
)
from strata.schemas import AUDIO_COLS, CATALOGUE_COLS


def _q(c: str) -> str:
    return f'"{c}"'


def rhu(expr: str, digits: int) -> str:
    """Half away from zero on the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def eavg(col: str, digits: int, scale: int = 12) -> str:
    """The average rounded half away from zero, in whole numbers: with S the sum of the
    values times 10^scale and n their count, the nearest integer to S * 10^digits / (n * 10^scale)."""
    total = f"sum(CAST(CAST({col} AS DECIMAL(38,{scale})) * {10 ** scale} AS HUGEINT))"
    unit = f"(count({col})::HUGEINT * {10 ** scale})"
    return (f"(sign({total}) * ((2 * abs({total}) * {10 ** digits} + {unit}) // (2 * {unit})))::DOUBLE / 1e{digits}")


def _lst(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _date(d: str) -> str:
    return f"DATE '{d}'"


CAT = ", ".join(_q(c) for c in CATALOGUE_COLS)
AUD = ", ".join(_q(c) for c in AUDIO_COLS)
ORDER_CAT = ", ".join(f"{_q(c)} ASC NULLS FIRST" for c in CATALOGUE_COLS)
ORDER_AUD = ", ".join(f"{_q(c)} ASC NULLS FIRST" for c in AUDIO_COLS)
VALID_KEY = "track_id IS NOT NULL AND track_id <> ''"
R3 = "popularity BETWEEN 0 AND 100"
R4 = "danceability BETWEEN 0 AND 1 AND energy BETWEEN 0 AND 1"
R5 = "duration_ms > 30000"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "src": ((), """
SELECT p.p_name || ' ' || CAST(l.l_partkey AS VARCHAR) AS track_name,
       s.s_name AS artist_name,
       p.p_type AS genre,
       CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(l.l_quantity * 10000 AS INTEGER) AS duration_ms,
       CAST(CAST(l.l_discount AS DECIMAL(6,4)) * 10.5 AS DOUBLE) AS danceability,
       CAST(CAST(l.l_tax AS DECIMAL(6,4)) * 12.5 AS DOUBLE) AS energy,
       CAST(l.l_partkey % 12 AS INTEGER) AS "key",
       -l.l_quantity AS loudness,
       CAST(l.l_partkey % 2 AS INTEGER) AS "mode",
       CAST(CAST(l.l_linenumber AS DECIMAL(6,4)) * 0.1 AS DOUBLE) AS speechiness,
       CAST(CAST(l.l_discount AS DECIMAL(6,4)) * 10 AS DOUBLE) AS acousticness,
       CAST(CAST(l.l_tax AS DECIMAL(6,4)) * 10 AS DOUBLE) AS instrumentalness,
       CAST(CAST(l.l_linenumber AS DECIMAL(6,4)) * 0.125 AS DOUBLE) AS liveness,
       CAST(CAST(l.l_linenumber - 1 AS DECIMAL(6,4)) * 0.15 AS DOUBLE) AS valence,
       60e0 + 2e0 * l.l_quantity AS tempo,
       CAST(3 + l.l_linenumber % 3 AS INTEGER) AS time_signature,
       CAST(floor(l.l_extendedprice / 1000e0) AS INTEGER) AS popularity
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""),
    "src_k": (("src",), "SELECT substr(md5(track_name || artist_name), 1, 16) AS track_id, * FROM src"),
    "cat_raw": (("src_k",), """
SELECT track_id, substr(track_name, 1, 500) AS track_name, substr(artist_name, 1, 500) AS artist_name,
       nullif(genre, '') AS genre,
       CASE WHEN year BETWEEN 1000 AND 9999 THEN year END AS year,
       CAST(CASE WHEN duration_ms >= 0 THEN duration_ms END AS BIGINT) AS duration_ms
FROM src_k"""),
    "aud_raw": (("src_k",), f"SELECT track_id, {AUD} FROM src_k"),
    "cat_dd": (("cat_raw",), f"""
SELECT track_id, {CAT} FROM (
  SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY {ORDER_CAT}) AS _rn
  FROM cat_raw WHERE {VALID_KEY}) t WHERE _rn = 1"""),
    "aud_dd": (("aud_raw",), f"""
SELECT track_id, {AUD} FROM (
  SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY {ORDER_AUD}) AS _rn
  FROM aud_raw WHERE {VALID_KEY}) t WHERE _rn = 1"""),
    "cat_ok": (("cat_dd",), f"SELECT * FROM cat_dd WHERE {R5}"),
    "aud_ok": (("aud_dd",), f"SELECT * FROM aud_dd WHERE {R3} AND {R4}"),
    "unified": (("cat_ok", "aud_ok"), f"""
SELECT c.track_id, {", ".join("c." + _q(x) for x in CATALOGUE_COLS)}, {", ".join("a." + _q(x) for x in AUDIO_COLS)}
FROM cat_ok c JOIN aud_ok a ON c.track_id = a.track_id"""),
    "silver_rows": (("unified",), """
SELECT u.*,
       CAST(floor(year / 10) * 10 AS INTEGER) AS decade,
       round(duration_ms / 1000e0, 1) AS duration_sec,
       CASE WHEN popularity >= 70 THEN 'High' WHEN popularity >= 40 THEN 'Medium' ELSE 'Low' END
         AS popularity_category,
       coalesce(acousticness >= 0.5, false) AS is_acoustic
FROM unified u"""),
    "silver": (("silver_rows",), """
SELECT s.*,
       rank() OVER (PARTITION BY genre ORDER BY popularity DESC NULLS LAST) AS rank_in_genre,
       lag(popularity) OVER (PARTITION BY artist_name
                             ORDER BY year ASC NULLS FIRST, track_id ASC NULLS FIRST)
         AS pop_prev_year
FROM silver_rows s"""),
    "dm_tracks": (("silver",), f"""
SELECT track_id, track_name, artist_name, genre, year, popularity, danceability, energy, valence,
       tempo, acousticness, instrumentalness, duration_ms, rank_in_genre, popularity_category,
       {_date(AS_OF)} AS ingestion_date
FROM silver"""),
    "trends_agg": (("silver_rows",), f"""
SELECT genre, decade, {eavg("popularity", 2)} AS avg_popularity, count(track_id) AS nb_tracks,
       {eavg("danceability", 4)} AS avg_danceability, {eavg("energy", 4)} AS avg_energy
FROM silver_rows GROUP BY genre, decade"""),
    "top": (("silver_rows",), """
SELECT genre AS g, decade AS d, track_name AS top_track_name FROM (
  SELECT genre, decade, track_name,
         row_number() OVER (PARTITION BY genre, decade
                            ORDER BY popularity DESC NULLS LAST, track_id ASC) AS rn
  FROM silver_rows) t WHERE rn = 1"""),
    "dm_trends": (("trends_agg", "top"), f"""
SELECT a.genre, a.decade, a.avg_popularity, a.nb_tracks, a.avg_danceability, a.avg_energy,
       t.top_track_name, {_date(AS_OF)} AS ingestion_date
FROM trends_agg a LEFT JOIN top t ON a.genre = t.g AND a.decade = t.d"""),
    "art": (("silver_rows",), f"""
SELECT artist_name, decade, count(track_id) AS total_tracks, {eavg("popularity", 2)} AS avg_popularity,
       max(popularity) AS max_popularity, first(genre ORDER BY track_id) AS main_genre
FROM silver_rows GROUP BY artist_name, decade"""),
    "art_s": (("art",), f"""
SELECT *, {rhu("avg_popularity * ln(1 + total_tracks)", 2)} AS influence_score FROM art"""),
    "dm_artists": (("art_s",), f"""
SELECT artist_name, decade, total_tracks, avg_popularity, max_popularity, main_genre, influence_score,
       rank() OVER (PARTITION BY decade ORDER BY influence_score DESC NULLS LAST) AS rank_in_decade,
       {_date(AS_OF)} AS ingestion_date
FROM art_s"""),
    "dm_hits": (("silver_rows",), f"""
SELECT genre, year, track_id, track_name, artist_name, popularity, danceability, energy, valence,
       tempo, rank_in_year, {_date(AS_OF)} AS ingestion_date
FROM (SELECT *, rank() OVER (PARTITION BY genre, year ORDER BY popularity DESC NULLS LAST) AS rank_in_year
      FROM silver_rows) t
WHERE rank_in_year <= 10"""),
    "genre_stats": (("silver_rows",), f"""
SELECT genre, year, decade, {eavg("popularity", 2)} AS avg_popularity, count(track_id) AS nb_tracks,
       {eavg("tempo", 2)} AS avg_tempo, {eavg("energy", 4)} AS avg_energy,
       {eavg("danceability", 4)} AS avg_danceability, {eavg("valence", 4)} AS avg_valence
FROM silver_rows GROUP BY genre, year, decade"""),
}


def _resolve(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(final: str, *uses: str) -> str:
    chain = _resolve(uses)
    if not chain:
        return final.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1].strip()}\n)" for n in chain)
    return f"WITH {body}\n{final.strip()}"


def _page(table: str, where: str, order: str, page_no: int, size: int, cols: str = "*") -> str:
    w = f"WHERE {where}" if where else ""
    return f"SELECT {cols} FROM {table} {w} ORDER BY {order} LIMIT {size} OFFSET {(page_no - 1) * size}"


def _meta(table: str, where: str, page_no: int, size: int) -> str:
    w = f"WHERE {where}" if where else ""
    return (f"SELECT count(*) AS total, {page_no} AS page, {size} AS page_size, "
            f"CAST(ceil(count(*) / {size}e0) AS BIGINT) AS total_pages FROM {table} {w}")


def _report_row(source: str, order: int, rule: str, rows_in: str, rejected: str, frm: str) -> str:
    return (f"SELECT '{source}' AS source, CAST({order} AS INTEGER) AS rule_order, '{rule}' AS rule, "
            f"CAST({rows_in} AS BIGINT) AS rows_in, CAST({rejected} AS BIGINT) AS rejected, "
            f"CAST(({rows_in}) - ({rejected}) AS BIGINT) AS rows_out FROM {frm}")


def _dq_report() -> str:
    parts = []
    for src, raw, dd, ok_rules in (
        ("catalogue", "cat_raw", "cat_dd", [(5, "R5_min_duration", R5)]),
        ("audio_features", "aud_raw", "aud_dd",
         [(3, "R3_popularity_range", R3), (4, "R4_unit_range", R4)]),
    ):
        parts.append(_report_row(src, 1, "R1_key_not_blank", "count(*)",
                                 f"count(*) FILTER (WHERE NOT ({VALID_KEY}))", raw))
        parts.append(_report_row(src, 2, "R2_unique_key", f"count(*) FILTER (WHERE {VALID_KEY})",
                                 f"count(*) FILTER (WHERE {VALID_KEY}) - count(DISTINCT track_id) "
                                 f"FILTER (WHERE {VALID_KEY})", raw))
        passed = "TRUE"
        for order, name, cond in ok_rules:
            parts.append(_report_row(src, order, name, f"count(*) FILTER (WHERE {passed})",
                                     f"count(*) FILTER (WHERE {passed} AND NOT coalesce({cond}, false))",
                                     dd))
            passed = f"{passed} AND coalesce({cond}, false)"
    parts.append(_report_row(
        "audio_features", 6, "R6_key_in_catalogue", "count(*)",
        "count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM cat_ok c WHERE c.track_id = a.track_id))",
        "aud_ok a"))
    return sql("\nUNION ALL\n".join(parts), "cat_raw", "aud_raw", "cat_dd", "aud_dd", "cat_ok", "aud_ok")


def _ws_chars() -> str:
    return " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def _typed(col: str, t: str) -> str:
    return f"CAST({col} AS {t}) AS {col}"


TRACK_TYPES = [
    ("track_id", "VARCHAR"), ("track_name", "VARCHAR"), ("artist_name", "VARCHAR"),
    ("genre", "VARCHAR"), ("year", "SMALLINT"), ("popularity", "SMALLINT"),
    ("danceability", "DECIMAL(6,4)"), ("energy", "DECIMAL(6,4)"), ("valence", "DECIMAL(6,4)"),
    ("tempo", "DECIMAL(8,2)"), ("acousticness", "DECIMAL(6,4)"), ("instrumentalness", "DECIMAL(6,4)"),
    ("duration_ms", "BIGINT"), ("rank_in_genre", "INTEGER"), ("popularity_category", "VARCHAR"),
    ("ingestion_date", "DATE"),
]
TREND_TYPES = [
    ("genre", "VARCHAR"), ("decade", "SMALLINT"), ("avg_popularity", "DECIMAL(6,2)"), ("nb_tracks", "INTEGER"),
    ("avg_danceability", "DECIMAL(6,4)"), ("avg_energy", "DECIMAL(6,4)"), ("top_track_name", "VARCHAR"),
    ("ingestion_date", "DATE"),
]
HIT_TYPES = [
    ("genre", "VARCHAR"), ("year", "SMALLINT"), ("track_id", "VARCHAR"), ("track_name", "VARCHAR"),
    ("artist_name", "VARCHAR"), ("popularity", "SMALLINT"), ("danceability", "DECIMAL(6,4)"),
    ("energy", "DECIMAL(6,4)"), ("valence", "DECIMAL(6,4)"), ("tempo", "DECIMAL(8,2)"),
    ("rank_in_year", "INTEGER"), ("ingestion_date", "DATE"),
]
ARTIST_TYPES = [
    ("artist_name", "VARCHAR"), ("decade", "SMALLINT"), ("total_tracks", "INTEGER"),
    ("avg_popularity", "DECIMAL(6,2)"), ("max_popularity", "DECIMAL(6,2)"), ("main_genre", "VARCHAR"),
    ("influence_score", "DECIMAL(10,2)"), ("rank_in_decade", "INTEGER"), ("ingestion_date", "DATE"),
]

_SEL = f"genre IN ({_lst(SEL_GENRES)}) AND year BETWEEN {SEL_YEARS[0]} AND {SEL_YEARS[1]}"
_TRACK_ORDER = "popularity DESC NULLS LAST, track_id ASC NULLS FIRST"
_y = lambda d: tuple(int(x) for x in d.split("-"))


def oracle_sql() -> dict[str, str]:
    d1, d2 = _y(DAY_1), _y(DAY_2)
    a = _y(AS_OF)
    q = {
        # sources / sinks
        "split_catalogue": sql("SELECT track_id, track_name, artist_name, genre, CAST(year AS VARCHAR) AS year, "
                               "CAST(duration_ms AS VARCHAR) AS duration_ms FROM src_k", "src_k"),
        "split_audio": sql(f"SELECT track_id, {AUD} FROM src_k", "src_k"),
        "split_counts": ("SELECT count(*) AS rows_read, count(*) FILTER (WHERE l_linenumber >= 6) AS rows_skipped, "
                         "count(*) FILTER (WHERE l_linenumber < 6) AS rows_written FROM lineitem"),
        "key_md5": sql("SELECT track_id, track_name, artist_name FROM src_k", "src_k"),
        "strip_ws": f"SELECT doc_id, trim(text, {_ws_chars()}) AS text FROM documents",
        "src_csv_wide": sql("SELECT track_name || ', \"live\"' || chr(10) || 'final' AS track_name, "
                            + ", ".join(_q(c) for c in CATALOGUE_COLS[1:-1]) + f", CAST(duration_ms AS BIGINT) AS duration_ms, {AUD} FROM src", "src"),
        "src_csv_wide_split": sql("SELECT track_name || ', \"live\"' || repeat(chr(10) || 'final', 1 + CAST(\"key\" % 3 AS INTEGER)) AS track_name, "
                                  + ", ".join(_q(c) for c in CATALOGUE_COLS[1:-1])
                                  + f", CAST(duration_ms AS BIGINT) AS duration_ms, {AUD} FROM src", "src"),
        "src_csv_typed": sql(f"SELECT track_id, {AUD} FROM src_k", "src_k"),
        "ingest_partition": sql(f"SELECT track_id, {AUD}, {a[0]} AS ingestion_year, {a[1]} AS ingestion_month, "
                                f"{a[2]} AS ingestion_day FROM aud_raw", "aud_raw"),
        "src_raw_parquet": sql(f"SELECT * FROM aud_raw", "aud_raw"),
        "src_raw_one_day": sql(f"SELECT * FROM aud_raw", "aud_raw"),
        "sink_dynamic_overwrite": sql(
            f"SELECT *, {d1[0]} AS ingestion_year, {d1[1]} AS ingestion_month, {d1[2]} AS ingestion_day FROM cat_raw "
            f"UNION ALL SELECT *, {d2[0]}, {d2[1]}, {d2[2]} FROM cat_raw WHERE {R5}", "cat_raw"),
        "sink_table": sql("SELECT * FROM genre_stats", "genre_stats"),
        "silver_append": sql("SELECT * FROM genre_stats UNION ALL SELECT * FROM genre_stats", "genre_stats"),
        "silver_runs": sql("SELECT * FROM genre_stats UNION ALL SELECT * FROM genre_stats", "genre_stats"),
        "load_catalogue": sql("SELECT track_id, track_name || chr(10) || 'side \"B\"' AS track_name, artist_name, genre, year, "
                              "CASE WHEN year = 1998 THEN 3000000000 + duration_ms ELSE duration_ms END AS duration_ms "
                              "FROM cat_raw", "cat_raw"),
        "src_table": sql("SELECT * FROM silver", "silver"),
        "stream_land_audio": sql(f"SELECT track_id, {AUD}, {a[0]} AS ingestion_year, {a[1]} AS ingestion_month, "
                                 f"{a[2]} AS ingestion_day FROM aud_raw", "aud_raw"),
        # quality
        "dq_r1": sql("SELECT s.source, CASE WHEN track_id < '1' THEN '' END AS track_id FROM src_k, "
                     "(VALUES ('catalogue'), ('audio_features')) s(source) WHERE track_id < '2'", "src_k"),
        "dq_dedup_catalogue": sql("SELECT * FROM cat_dd", "cat_dd"),
        "dq_dedup_audio": sql("SELECT * FROM aud_dd", "aud_dd"),
        "dq_r3": sql(f"SELECT *, 'R3_popularity_range' AS failed_rule FROM aud_dd "
                     f"WHERE NOT coalesce({R3}, false)", "aud_dd"),
        "dq_r4": sql(f"SELECT *, 'R4_unit_range' AS failed_rule FROM aud_dd "
                     f"WHERE coalesce({R3}, false) AND NOT coalesce({R4}, false)", "aud_dd"),
        "dq_r5": sql(f"SELECT *, 'R5_min_duration' AS failed_rule FROM cat_dd "
                     f"WHERE NOT coalesce({R5}, false)", "cat_dd"),
        "dq_orphans": sql("SELECT * FROM aud_ok a WHERE NOT EXISTS "
                          "(SELECT 1 FROM cat_ok c WHERE c.track_id = a.track_id)", "aud_ok", "cat_ok"),
        "dq_r6_semi": sql("SELECT * FROM aud_ok a WHERE EXISTS "
                          "(SELECT 1 FROM cat_ok c WHERE c.track_id = a.track_id)", "aud_ok", "cat_ok"),
        "dq_report": _dq_report(),
        # silver
        "silver_unified": sql("SELECT * FROM unified", "unified"),
        "silver_enriched": sql("SELECT * FROM silver", "silver"),
        "enrich_decade": sql("SELECT track_id, year, decade FROM silver_rows", "silver_rows"),
        "enrich_duration": sql("SELECT track_id, duration_ms, duration_sec FROM silver_rows", "silver_rows"),
        "enrich_category": sql("SELECT track_id, popularity, popularity_category FROM silver_rows",
                               "silver_rows"),
        "enrich_flag": sql("SELECT track_id, acousticness, is_acoustic FROM silver_rows", "silver_rows"),
        "rank_in_genre": sql("SELECT track_id, genre, popularity, rank_in_genre FROM silver", "silver"),
        "lag_prev": sql("SELECT track_id, artist_name, year, popularity, pop_prev_year FROM silver", "silver"),
        "lag_prev_blocked": sql("SELECT track_id, artist_name, year, popularity, pop_prev_year FROM silver",
                                "silver"),
        "exact_avg": sql(f"SELECT genre, {eavg('valence', 4)} AS avg_valence, {eavg('liveness', 4)} AS avg_liveness, "
                         f"{eavg('loudness', 2)} AS avg_loudness, {eavg('speechiness', 4)} AS avg_speechiness "
                         "FROM unified GROUP BY genre", "unified"),
        "avg_fine": (f"SELECT l_orderkey, {eavg('(l_partkey / 1e7)', 6)} AS avg_fine, {eavg('l_discount', 2)} AS avg_discount, "
                     f"{eavg('l_tax', 2)} AS avg_tax, {eavg('l_linenumber', 0)} AS avg_line FROM lineitem GROUP BY l_orderkey"),
        "avg_boundary": (
            "WITH s AS (SELECT l_returnflag, l_linestatus, count(*) AS n, 1 + (200 - count(*) % 200) % 200 AS pad FROM lineitem GROUP BY ALL), "
            "v AS (SELECT l_returnflag, l_linestatus, 0::BIGINT AS v FROM lineitem UNION ALL "
            "SELECT l_returnflag, l_linestatus, CASE WHEN i = 1 THEN (n + pad) // 200 ELSE 0 END FROM s, range(1, 201) t(i) WHERE i <= pad) "
            f"SELECT l_returnflag, l_linestatus, count(v) AS n, {eavg('v', 2)} AS avg_low, {eavg('(-v)', 2)} AS avg_negative, "
            f"{eavg('v', 2)} AS avg_decimal FROM v GROUP BY l_returnflag, l_linestatus"),
        "genre_stats": sql("SELECT * FROM genre_stats", "genre_stats"),
        "artist_stats": sql("SELECT artist_name, decade, total_tracks, avg_popularity, main_genre FROM art", "art"),
        # gold
        "dm_tracks": sql("SELECT * FROM dm_tracks", "dm_tracks"),
        "dm_genre_trends": sql("SELECT * FROM dm_trends", "dm_trends"),
        "top_track": sql("SELECT genre, decade, top_track_name FROM dm_trends", "dm_trends"),
        "dm_top_artists": sql("SELECT * FROM dm_artists", "dm_artists"),
        "dm_hits": sql("SELECT * FROM dm_hits", "dm_hits"),
        "gold_typed_tracks": sql("SELECT " + ", ".join(_typed(c, t) for c, t in TRACK_TYPES) + " FROM dm_tracks",
                                 "dm_tracks"),
        "gold_typed_artists": sql("SELECT " + ", ".join(_typed(c, t) for c, t in ARTIST_TYPES)
                                  + " FROM dm_artists", "dm_artists"),
        "gold_typed_trends": sql("SELECT " + ", ".join(_typed(c, t) for c, t in TREND_TYPES) + " FROM dm_trends",
                                 "dm_trends"),
        "gold_typed_hits": sql("SELECT " + ", ".join(_typed(c, t) for c, t in HIT_TYPES) + " FROM dm_hits", "dm_hits"),
        "gold_counts": sql("SELECT 'dm_track_popularity' AS mart, count(*) AS n_rows FROM dm_tracks "
                           "UNION ALL SELECT 'dm_genre_trends', count(*) FROM dm_trends "
                           "UNION ALL SELECT 'dm_top_artists', count(*) FROM dm_artists "
                           "UNION ALL SELECT 'dm_hits_emergents', count(*) FROM dm_hits",
                           "dm_tracks", "dm_trends", "dm_artists", "dm_hits"),
        "top_influence": sql("SELECT artist_name, decade, influence_score, rank_in_decade FROM dm_artists "
                             "ORDER BY influence_score DESC NULLS LAST, artist_name, decade LIMIT 10",
                             "dm_artists"),
        "check_silver": sql(
            "SELECT count(*) AS total_rows, count(DISTINCT track_id) AS distinct_tracks, "
            "count(*) FILTER (WHERE track_id IS NULL OR track_id = '') AS null_track_id, "
            "count(*) FILTER (WHERE popularity < 0 OR popularity > 100) AS invalid_popularity FROM silver",
            "silver"),
        "check_genres": sql(f"SELECT genre, count(*) AS nb_tracks, {eavg('popularity', 2)} AS avg_pop "
                            "FROM silver_rows GROUP BY genre ORDER BY nb_tracks DESC, genre ASC NULLS FIRST "
                            "LIMIT 10", "silver_rows"),
        "check_genres_gold": sql(f"SELECT genre, count(*) AS nb_tracks, {eavg('popularity', 2)} AS avg_pop "
                                 "FROM dm_tracks GROUP BY genre ORDER BY nb_tracks DESC, genre ASC NULLS FIRST "
                                 "LIMIT 10", "dm_tracks"),
        # serving
        "tracks_artist": sql(_page("dm_tracks", "contains(artist_name, '#00000002')", _TRACK_ORDER, 1, 50),
                             "dm_tracks"),
        "tracks_artist_ci": sql(_page("dm_tracks", "contains(lower(strip_accents(artist_name)), 'supplier#00000002')",
                                      _TRACK_ORDER, 1, 50), "dm_tracks"),
        "tracks_filtered": sql(_page("dm_tracks", "genre = 'SMALL' AND year = 1998 AND popularity >= 50",
                                     _TRACK_ORDER, 2, 20), "dm_tracks"),
        "tracks_minpop": sql(_page("dm_tracks", "popularity >= 95 AND rank_in_genre <= 400",
                                   _TRACK_ORDER, 1, 200), "dm_tracks"),
        "trends_filtered": sql(_page("dm_trends", "decade = 1990",
                                     "decade ASC NULLS FIRST, avg_popularity DESC NULLS LAST, genre ASC NULLS FIRST",
                                     1, 50), "dm_trends"),
        "artists_maxrank": sql(_page("dm_artists", "rank_in_decade <= 5",
                                     "decade ASC NULLS FIRST, rank_in_decade ASC NULLS FIRST, "
                                     "artist_name ASC NULLS FIRST", 1, 200), "dm_artists"),
        "hits_filtered": sql(_page("dm_hits", "genre = 'ECONOMY'",
                                   "year DESC NULLS LAST, rank_in_year ASC NULLS FIRST, genre ASC NULLS FIRST, "
                                   "track_id ASC NULLS FIRST", 2, 40), "dm_hits"),
        "genres": sql("SELECT DISTINCT genre FROM dm_tracks WHERE genre IS NOT NULL", "dm_tracks"),
        "year_range": sql("SELECT CAST(CASE WHEN min(year) IS NULL THEN 2000 ELSE min(year) END AS INTEGER) AS y_min, "
                          "CAST(CASE WHEN min(year) IS NULL THEN 2023 ELSE max(year) END AS INTEGER) AS y_max "
                          "FROM dm_tracks", "dm_tracks"),
        "decades": sql("SELECT DISTINCT decade FROM dm_trends WHERE decade IS NOT NULL", "dm_trends"),
        "summary": sql(f"SELECT count(*) AS total_tracks, count(DISTINCT genre) AS nb_genres, "
                       f"{eavg('popularity', 1)} AS avg_pop, {eavg('tempo', 1)} AS avg_tempo "
                       f"FROM dm_tracks WHERE {_SEL}", "dm_tracks"),
        "pop_by_genre": sql(f"SELECT genre, {eavg('popularity', 2)} AS avg_popularity, count(*) AS total_tracks "
                            f"FROM dm_tracks WHERE {_SEL} GROUP BY genre", "dm_tracks"),
        "evolution": sql("SELECT genre, decade, avg_popularity, avg_danceability, avg_energy, nb_tracks "
                         f"FROM dm_trends WHERE genre IN ({_lst(EVOLUTION_GENRES[:5])})", "dm_trends"),
        "top_artists": sql("SELECT artist_name, avg_popularity, total_tracks, influence_score, rank_in_decade, "
                           "main_genre FROM dm_artists WHERE decade = 1990 "
                           "ORDER BY rank_in_decade, artist_name LIMIT 20", "dm_artists"),
        "hits": sql("SELECT track_name, artist_name, popularity, danceability, energy, valence, tempo, "
                    "rank_in_year, track_id FROM dm_hits WHERE genre = 'LARGE' AND year = 2000 "
                    "ORDER BY rank_in_year, track_id LIMIT 10", "dm_hits"),
        "raw_top": sql("SELECT track_id, track_name, artist_name, genre, year, popularity, danceability, energy, "
                       "valence, tempo, popularity_category, rank_in_genre FROM dm_tracks "
                       f"WHERE genre IN ({_lst(ALL_GENRES)}) AND year BETWEEN 1995 AND 2001 "
                       f"ORDER BY {_TRACK_ORDER} LIMIT 100", "dm_tracks"),
        "page": sql(_page("dm_tracks", "", _TRACK_ORDER, 3, 50), "dm_tracks"),
        "page_meta": sql(_meta("dm_tracks", "genre = 'MEDIUM'", 1, 30), "dm_tracks"),
        "page_indexed": sql(_page("dm_tracks", "", _TRACK_ORDER, 60, 50), "dm_tracks"),
        "page_genre_indexed": sql(_page("dm_tracks", "genre = 'MEDIUM'", _TRACK_ORDER, 9, 40), "dm_tracks"),
        "page_meta_indexed": sql(_meta("dm_tracks", "genre = 'MEDIUM'", 1, 30), "dm_tracks"),
        "tracks_rank_indexed": sql("SELECT * FROM dm_tracks WHERE genre = 'SMALL' AND rank_in_genre <= 40 AND popularity >= 50",
                                   "dm_tracks"),
        "tracks_artist_indexed": sql("SELECT * FROM dm_tracks WHERE artist_name = 'Supplier#000000002'", "dm_tracks"),
        # generic shapes on other driver tables
        "rank_part_price": ("SELECT p_partkey, p_type, p_retailprice, rank() OVER (PARTITION BY p_type "
                            "ORDER BY p_retailprice DESC NULLS LAST) AS price_rank FROM part"),
        "lag_events": ("SELECT event_id, user_id, ts, value, lag(value) OVER (PARTITION BY user_id "
                       "ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST) AS prev_value FROM events"),
        "rank_order_price": ("SELECT o_orderkey, o_orderstatus, o_totalprice, rank() OVER (PARTITION BY o_orderstatus "
                             "ORDER BY o_totalprice DESC NULLS LAST) AS price_rank FROM orders"),
        "rank_quantity": ("SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag "
                          "ORDER BY l_quantity ASC NULLS FIRST) AS quantity_rank FROM lineitem"),
        "distinct_priority": "SELECT DISTINCT o_orderpriority FROM orders",
        "orders_stats": (f"SELECT o_orderstatus, o_orderpriority, {eavg('o_totalprice', 2)} AS avg_o_totalprice, "
                         "count(o_orderkey) AS n_orders, "
                         "first(o_orderkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS top_order "
                         "FROM orders GROUP BY o_orderstatus, o_orderpriority"),
        "page_customers": _page("customer", "", "c_acctbal DESC NULLS LAST, c_custkey ASC NULLS FIRST", 2, 100,
                                "c_custkey, c_name, c_acctbal, c_mktsegment"),
        "page_customers_meta": _meta("customer", "c_mktsegment = 'BUILDING'", 1, 75),
    }
    q["summary_merged"], q["pop_by_genre_merged"] = q["summary"], q["pop_by_genre"]
    return q
