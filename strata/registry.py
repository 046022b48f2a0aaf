"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables in ``sf_dir`` (through the F-SRC mapping for
the music-shaped ones), so its work grows with them. Queries that exercise a sink
write into a fresh folder under ``spark.checkpoint.dir`` and read the result back.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exact import exact_avg
from strata.functions.text import strip_ws
from strata.operators.ingest import add_ingestion_partition
from strata.operators.load import catalogue_columns, load_catalogue, parse_typed, typed_columns
from strata.operators.paging import page, page_meta
from strata.operators.quality import first_failure, key_present
from strata.operators.ranking import lag_by_range, rank_by_histogram, rank_by_range
from strata.operators.split import normalize_wide, split_counts, split_wide
from strata.plans import checks, gold, headline, marts, silver
from strata.schemas import AUDIO, CATALOGUE_COLS, AUDIO_COLS, KEY, WIDE_TYPED
from strata.session import materialize, scratch_database, scratch_path
from strata.sinks.clustered import write_clustered
from strata.sinks.runs import RunStore
from strata.sinks.writers import write_csv, write_raw_parquet, write_table
from strata.sources.files import read_csv_typed, read_csv_wide, read_raw_parquet, read_table
from strata.sources.wide import read_csv_wide_parallel
from strata.sources.fixtures import damaged_keys, damaged_source, table, wide_source

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-06-30"
DAY_1, DAY_2 = "2024-06-29", "2024-06-30"

# Serving-query parameters (values present in the driver data).
SEL_GENRES = ["ECONOMY", "SMALL", "PROMO"]
SEL_YEARS = (1996, 1999)
ALL_GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVOLUTION_GENRES = ["STANDARD", "SMALL", "PROMO", "MEDIUM", "LARGE", "ECONOMY", "NONE"]


# ---------------------------------------------------------------- building blocks
def sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Typed (catalogue, audio) raw tables: split the wide source, then load."""
    cat_s, aud_s = split_wide(wide_source(spark, sf))
    return load_catalogue(cat_s), parse_typed(aud_s, AUDIO)


def split_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Both typed halves side by side (one row per source row)."""
    n = normalize_wide(wide_source(spark, sf)).filter(F.col("_keep"))
    return n.select(KEY, *catalogue_columns(), *typed_columns(AUDIO)[1:])


def checked(spark: SparkSession, sf: str) -> silver.Checked:
    """Both halves come from one split, so they are checked in one aggregate."""
    return silver.check_split(split_typed(spark, sf))


def unified(spark: SparkSession, sf: str) -> DataFrame:
    return silver.unify(checked(spark, sf))


def silver_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Silver columns without rank_in_genre and pop_prev_year (enough for every aggregate mart)."""
    return silver.with_scalars(unified(spark, sf))


def silver_full(spark: SparkSession, sf: str, rank_form: str = "histogram") -> DataFrame:
    return silver.enrich(unified(spark, sf), rank_form=rank_form)


def mart_tracks(spark, sf):
    # DM1 needs the rank but not the lag column, so only the rank step runs
    ranked = silver.add_rank(materialize(unified(spark, sf)))
    return gold.dm_tracks(silver.with_scalars(ranked), AS_OF)


def mart_tracks_unranked(spark, sf):
    """DM1 for queries that do not read the rank: no histogram, no join."""
    plain = silver_rows(spark, sf).withColumn("rank_in_genre", F.lit(None).cast("bigint"))
    return gold.dm_tracks(plain, AS_OF).drop("rank_in_genre")


def mart_trends(spark, sf):
    return gold.dm_genre_trends(silver_rows(spark, sf), AS_OF)


def mart_artists(spark, sf):
    return gold.dm_top_artists(silver_rows(spark, sf), AS_OF)


def mart_hits(spark, sf):
    # the histogram top-N reads its input twice (histogram, then filter): give it a
    # written silver table, as the gold job does
    return gold.dm_hits(materialize(silver_rows(spark, sf)), AS_OF)


# ---------------------------------------------------------------- sources / sinks
def q_split_catalogue(spark, sf):
    return split_wide(wide_source(spark, sf))[0]


def q_split_audio(spark, sf):
    return parse_typed(split_wide(wide_source(spark, sf))[1], AUDIO)


def q_split_counts(spark, sf):
    return split_counts(damaged_source(spark, sf))


def q_key_md5(spark, sf):
    return normalize_wide(wide_source(spark, sf)).select(KEY, "track_name", "artist_name")


def q_strip_ws(spark, sf):
    """Texts wrapped in white space, which only the outside may lose."""
    docs = table(spark, sf, "documents")
    outer = F.concat(F.lit("\u3000\t"), F.col("text"), F.lit("\u00a0\x1c "))
    return docs.select("doc_id", strip_ws(F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(outer)).alias("text"))


def q_src_csv_wide(spark, sf):
    path = scratch_path(spark, "wide_csv")
    broken = F.concat(F.col("track_name"), F.lit(', "live"\nfinal'))
    write_csv(wide_source(spark, sf).withColumn("track_name", broken), path)
    return parse_typed(read_csv_wide(spark, path), WIDE_TYPED)


def q_src_csv_wide_split(spark, sf):
    """The same file, read by splits: quoted newlines of any number, doubled quotes and commas."""
    path = scratch_path(spark, "wide_csv")
    broken = F.concat(F.col("track_name"), F.lit(', "live"'), F.repeat(F.lit("\nfinal"), 1 + F.col("key").cast("int") % 3))
    write_csv(wide_source(spark, sf).withColumn("track_name", broken), path)
    return parse_typed(read_csv_wide_parallel(spark, path), WIDE_TYPED)


def q_src_csv_typed(spark, sf):
    path = scratch_path(spark, "audio_csv")
    write_csv(split_wide(wide_source(spark, sf))[1], path)
    return read_csv_typed(spark, path, AUDIO)


def q_ingest_partition(spark, sf):
    return add_ingestion_partition(sources(spark, sf)[1], AS_OF)


def q_src_raw_parquet(spark, sf):
    path = scratch_path(spark, "raw_audio")
    write_raw_parquet(add_ingestion_partition(sources(spark, sf)[1], AS_OF), path, "overwrite")
    return read_raw_parquet(spark, path)


def q_src_raw_one_day(spark, sf):
    """Two landed days; reading one is pruned at the directory level."""
    import datetime as dt
    path = scratch_path(spark, "raw_audio_days")
    aud = sources(spark, sf)[1]
    write_raw_parquet(add_ingestion_partition(aud.filter(F.col("popularity") >= 50), DAY_1), path, "append")
    write_raw_parquet(add_ingestion_partition(aud, DAY_2), path, "append")
    return read_raw_parquet(spark, path, as_of=dt.date.fromisoformat(DAY_2))


def q_sink_dynamic_overwrite(spark, sf):
    """Two days landed, then day 2 overwritten alone: day 1 must survive."""
    path = scratch_path(spark, "raw_catalogue")
    cat = sources(spark, sf)[0]
    write_raw_parquet(add_ingestion_partition(cat, DAY_1), path, "append")
    write_raw_parquet(add_ingestion_partition(cat, DAY_2), path, "append")
    redo = cat.filter(F.col("duration_ms") > 30000)
    write_raw_parquet(add_ingestion_partition(redo, DAY_2), path, "overwrite")
    return read_raw_parquet(spark, path, drop_partitions=False)


def _saved_genre_stats(spark, sf) -> str:
    db = scratch_database(spark)
    write_table(silver.genre_stats(silver_rows(spark, sf)), f"{db}.genre_stats", "overwrite")
    return f"{db}.genre_stats"


def q_sink_table(spark, sf):
    return read_table(spark, _saved_genre_stats(spark, sf))


def q_src_table(spark, sf):
    """Silver track table written to the warehouse, then scanned by name."""
    db = scratch_database(spark)
    write_table(silver_full(spark, sf), f"{db}.tracks_unified", "overwrite")
    return read_table(spark, f"{db}.tracks_unified")


def q_stream_land_audio(spark, sf):
    """Audio CSV files landed by the availableNow stream, read back from raw."""
    from strata.streaming import land_new_files
    landing, raw = scratch_path(spark, "landing"), scratch_path(spark, "raw_stream")
    write_csv(split_wide(wide_source(spark, sf))[1], landing)
    land_new_files(spark, landing, raw, scratch_path(spark, "stream_ckpt"), as_of=AS_OF)
    return read_raw_parquet(spark, raw, drop_partitions=False)


def q_silver_append(spark, sf):
    """Two appended runs of the silver job over one raw layer: genre statistics are those
    of the first run and those of the second."""
    from strata.plans.jobs import JobConfig, build_silver
    raw, db = scratch_path(spark, "raw_append"), scratch_database(spark)
    cfg = JobConfig(raw_root=raw, silver_db=db, table_mode="append")
    cat, aud = sources(spark, sf)
    write_raw_parquet(add_ingestion_partition(cat, AS_OF), cfg.raw("catalogue"), "append")
    write_raw_parquet(add_ingestion_partition(aud, AS_OF), cfg.raw("audio_features"), "append")
    for _ in range(2):
        build_silver(spark, cfg)
    return read_table(spark, f"{db}.genre_stats")


def q_silver_runs(spark, sf):
    """Two appended runs as repeatable ones: the second dies between its statistics tables, is
    repeated, and is repeated again after it was committed."""
    from strata.plans.jobs import JobConfig, build_silver
    raw, root = scratch_path(spark, "raw_runs"), scratch_path(spark, "silver_runs")
    cat, aud = sources(spark, sf)
    cfg = JobConfig(raw_root=raw, silver_root=root, table_mode="append", run_id="first")
    write_raw_parquet(add_ingestion_partition(cat, AS_OF), cfg.raw("catalogue"), "append")
    write_raw_parquet(add_ingestion_partition(aud, AS_OF), cfg.raw("audio_features"), "append")
    build_silver(spark, cfg)
    cfg.run_id = "second"
    dead = RunStore(spark, root).begin("second")
    dead.write(RunStore(spark, root).read("genre_stats"), "genre_stats")
    for _ in range(2):
        build_silver(spark, cfg)
    return RunStore(spark, root).read("genre_stats")


def q_load_catalogue(spark, sf):
    """Catalogue CSV -> per-column coercion -> table overwrite -> read back."""
    path = scratch_path(spark, "catalogue_csv")
    # Quoted newlines in names, and durations beyond 2^31 - 1 for some rows.
    cat = split_wide(wide_source(spark, sf))[0]
    cat = cat.withColumns({
        "track_name": F.concat(F.col("track_name"), F.lit('\nside "B"')),
        "duration_ms": F.when(F.col("year") == "1998", F.concat(F.lit("3"), F.lpad("duration_ms", 9, "0")))
                        .otherwise(F.col("duration_ms"))})
    write_csv(cat, path)
    loaded = load_catalogue(read_csv_wide(spark, path))
    db = scratch_database(spark)
    write_table(loaded, f"{db}.catalogue", "overwrite")
    return read_table(spark, f"{db}.catalogue")


# ---------------------------------------------------------------- quality
def q_dq_r1(spark, sf):
    cat, aud = (damaged_keys(df) for df in sources(spark, sf))
    bad = key_present(KEY)
    return (cat.filter(~bad).select(F.lit("catalogue").alias("source"), KEY)
            .unionByName(aud.filter(~bad).select(F.lit("audio_features").alias("source"), KEY)))


def _dedup(spark, sf, which):
    from strata.operators.quality import dedup_by_key
    cat, aud = sources(spark, sf)
    if which == "catalogue":
        return dedup_by_key(cat.filter(key_present(KEY)), KEY, CATALOGUE_COLS)
    return dedup_by_key(aud.filter(key_present(KEY)), KEY, AUDIO_COLS)


def q_dq_dedup_catalogue(spark, sf):
    return _dedup(spark, sf, "catalogue")


def q_dq_dedup_audio(spark, sf):
    return _dedup(spark, sf, "audio")


def _rejected(spark, sf, which, rule):
    rules = silver.CATALOGUE_RULES if which == "catalogue" else silver.AUDIO_RULES
    tagged = first_failure(_dedup(spark, sf, which), rules)
    return tagged.filter(F.col("failed_rule") == rule)


def q_dq_r3(spark, sf):
    return _rejected(spark, sf, "audio", "R3_popularity_range")


def q_dq_r4(spark, sf):
    return _rejected(spark, sf, "audio", "R4_unit_range")


def q_dq_r5(spark, sf):
    return _rejected(spark, sf, "catalogue", "R5_min_duration")


def q_dq_orphans(spark, sf):
    c = checked(spark, sf)
    return c.audio.kept.join(c.catalogue.kept.select(KEY), KEY, "left_anti")


def q_dq_r6_semi(spark, sf):
    c = checked(spark, sf)
    return c.audio.kept.join(c.catalogue.kept.select(KEY), KEY, "left_semi")


def q_dq_report(spark, sf):
    return silver.dq_report(checked(spark, sf))


# ---------------------------------------------------------------- silver
def q_silver_unified(spark, sf):
    return unified(spark, sf)


def q_silver_enriched(spark, sf):
    return silver_full(spark, sf)


def q_enrich_decade(spark, sf):
    return silver_rows(spark, sf).select(KEY, "year", "decade")


def q_enrich_duration(spark, sf):
    return silver_rows(spark, sf).select(KEY, "duration_ms", "duration_sec")


def q_enrich_category(spark, sf):
    return silver_rows(spark, sf).select(KEY, "popularity", "popularity_category")


def q_enrich_flag(spark, sf):
    return silver_rows(spark, sf).select(KEY, "acousticness", "is_acoustic")


def q_rank_in_genre(spark, sf):
    return silver.add_rank(materialize(unified(spark, sf))).select(
        KEY, "genre", "popularity", "rank_in_genre")


def q_lag_prev(spark, sf):
    return silver.add_lag(materialize(unified(spark, sf))).select(
        KEY, "artist_name", "year", "popularity", "pop_prev_year")


LAG_BLOCK_TEST_ROWS = 400  # small bound so the block path runs on the test tables


def q_lag_prev_blocked(spark, sf):
    """The lag with artists above a small bound split into (year, key-prefix)
    blocks, as happens to any artist too large for one task."""
    s = silver.add_lag(materialize(unified(spark, sf)), lag_window_max_rows=LAG_BLOCK_TEST_ROWS)
    return s.select(KEY, "artist_name", "year", "popularity", "pop_prev_year")


def q_exact_avg(spark, sf):
    return unified(spark, sf).groupBy("genre").agg(
        exact_avg("valence", 4).alias("avg_valence"),
        exact_avg("liveness", 4).alias("avg_liveness"),
        exact_avg("loudness", 2).alias("avg_loudness"),
        exact_avg("speechiness", 4).alias("avg_speechiness"))


def q_avg_fine(spark, sf):
    """Averages of values with seven decimals, and of few two-decimal values, whose
    averages are often exact halves of the last digit."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        exact_avg(F.col("l_partkey") / F.lit(1e7), 6).alias("avg_fine"),
        exact_avg("l_discount", 2).alias("avg_discount"), exact_avg("l_tax", 2).alias("avg_tax"),
        exact_avg("l_linenumber", 0, integral=True).alias("avg_line"))


def q_avg_boundary(spark, sf):
    """Averages of whole numbers in large groups, just below a half of the last digit: every
    flag and status gets up to 200 more rows, so that it has 200 k + 1, of which one holds k
    and the others 0."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    by = ["l_returnflag", "l_linestatus"]
    sizes = li.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    more = sizes.withColumn("pad", 1 + F.pmod(-F.col("n"), F.lit(200)))
    k = F.expr("(n + pad) div 200")
    rows = li.withColumn("v", F.lit(0).cast("long")).unionByName(more.select(
        *by, F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "pad"), lambda i: F.when(i == 1, k).otherwise(0))).alias("v")))
    return rows.groupBy(*by).agg(F.count("v").alias("n"), exact_avg("v", 2, integral=True).alias("avg_low"),
                                 exact_avg(-F.col("v"), 2, integral=True).alias("avg_negative"),
                                 exact_avg("v", 2).alias("avg_decimal"))


def q_genre_stats(spark, sf):
    return silver.genre_stats(silver_rows(spark, sf))


def q_artist_stats(spark, sf):
    return silver.artist_stats(silver_rows(spark, sf))


# ---------------------------------------------------------------- gold
def q_dm_tracks(spark, sf):
    return mart_tracks(spark, sf)


def q_dm_genre_trends(spark, sf):
    return mart_trends(spark, sf)


def q_top_track(spark, sf):
    return mart_trends(spark, sf).select("genre", "decade", "top_track_name")


def q_dm_top_artists(spark, sf):
    return mart_artists(spark, sf)


def q_dm_hits(spark, sf):
    return mart_hits(spark, sf)


def q_gold_typed_tracks(spark, sf):
    return gold.typed(mart_tracks(spark, sf), "dm_track_popularity")


def q_gold_typed_artists(spark, sf):
    return gold.typed(mart_artists(spark, sf), "dm_top_artists")


def q_gold_typed_trends(spark, sf):
    return gold.typed(mart_trends(spark, sf), "dm_genre_trends")


def q_gold_typed_hits(spark, sf):
    return gold.typed(mart_hits(spark, sf), "dm_hits_emergents")


def q_gold_counts(spark, sf):
    """Row count of each gold mart (one row per mart), all built from one silver table."""
    from functools import reduce
    s = materialize(silver_full(spark, sf))
    built = {"dm_track_popularity": gold.dm_tracks(s, AS_OF),
             "dm_genre_trends": gold.dm_genre_trends(s, AS_OF),
             "dm_top_artists": gold.dm_top_artists(s, AS_OF),
             "dm_hits_emergents": gold.dm_hits(s, AS_OF)}
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
             for name, df in built.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_top_influence(spark, sf):
    """The ten most influential (artist, decade) rows overall."""
    return marts.most_influential(mart_artists(spark, sf), 10)


def q_check_silver(spark, sf):
    # rows, keys and popularity are the same before and after the rank/lag columns
    return checks.silver_probe(unified(spark, sf))


def q_check_genres(spark, sf):
    return checks.genre_counts(silver_rows(spark, sf))


def q_check_genres_gold(spark, sf):
    return checks.genre_counts(mart_tracks_unranked(spark, sf))


# ---------------------------------------------------------------- serving
def q_tracks_artist(spark, sf):
    return marts.tracks(mart_tracks(spark, sf), artist="#00000002", page_no=1, page_size=50,
                        collation="UTF8_BINARY")


def q_tracks_artist_ci(spark, sf):
    return marts.tracks(mart_tracks(spark, sf), artist="supplier#00000002", page_no=1,
                        page_size=50, collation="UNICODE_CI_AI")


def q_tracks_filtered(spark, sf):
    return marts.tracks(mart_tracks(spark, sf), genre="SMALL", year=1998, min_popularity=50,
                        page_no=2, page_size=20)


def q_tracks_minpop(spark, sf):
    return marts.tracks(mart_tracks(spark, sf), min_popularity=95, max_rank=400, page_size=200)


def q_trends_filtered(spark, sf):
    return marts.genre_trends(mart_trends(spark, sf), decade=1990)


def q_artists_maxrank(spark, sf):
    return marts.top_artists(mart_artists(spark, sf), max_rank=5, page_size=200)


def q_hits_filtered(spark, sf):
    return marts.hits(mart_hits(spark, sf), genre="ECONOMY", page_no=2, page_size=40)


def q_genres(spark, sf):
    return marts.genres(mart_tracks_unranked(spark, sf))


def q_year_range(spark, sf):
    return marts.year_range(mart_tracks_unranked(spark, sf))


def q_decades(spark, sf):
    return marts.decades(mart_trends(spark, sf))


def q_summary(spark, sf):
    return marts.summary(mart_tracks_unranked(spark, sf), SEL_GENRES, SEL_YEARS)


def q_pop_by_genre(spark, sf):
    return marts.popularity_by_genre(mart_tracks_unranked(spark, sf), SEL_GENRES, SEL_YEARS)


def _headline(spark, sf):
    """Partial metrics of two landed days, the second one landed twice."""
    store, tracks = RunStore(spark, scratch_path(spark, "headline")), materialize(mart_tracks_unranked(spark, sf))
    late = F.substring("track_id", 1, 1) >= "8"
    for day, rows in ((DAY_1, ~late), (DAY_2, late), (DAY_2, late)):
        headline.add_run(store, day, tracks.filter(rows))
    return store.read(headline.TABLE)


def q_summary_merged(spark, sf):
    return headline.summary(_headline(spark, sf), SEL_GENRES, SEL_YEARS)


def q_pop_by_genre_merged(spark, sf):
    return headline.popularity_by_genre(_headline(spark, sf), SEL_GENRES, SEL_YEARS)


def q_evolution(spark, sf):
    return marts.evolution(mart_trends(spark, sf), EVOLUTION_GENRES)


def q_top_artists(spark, sf):
    return marts.top_artists_of(mart_artists(spark, sf), 1990, 20)


def q_hits(spark, sf):
    return marts.hits_of(mart_hits(spark, sf), "LARGE", 2000)


def q_raw_top(spark, sf):
    return marts.top_tracks(mart_tracks(spark, sf), ALL_GENRES, (1995, 2001), 100)


def q_page(spark, sf):
    rows = materialize(mart_tracks_unranked(spark, sf))
    return marts.tracks_page_ranked(rows, page_no=3, page_size=50).select(*gold.TRACK_COLUMNS, "ingestion_date")


def q_page_meta(spark, sf):
    return marts.tracks_meta(mart_tracks_unranked(spark, sf), genre="MEDIUM", page_size=30)


CLUSTER_ROWS = 2_000          # rows a file, so that the test tables fill many


def _clustered(spark, sf, index):
    c = gold.CLUSTERINGS["dm_track_popularity"][index]
    return write_clustered(mart_tracks(spark, sf), scratch_path(spark, "clustered"), c.order, c.key, indexes=c.indexes,
                           facets=c.facets, rows_per_file=CLUSTER_ROWS)


def q_page_indexed(spark, sf):
    """A deep page of the track list, read from the files that hold its offset."""
    return _clustered(spark, sf, "idx_popularity").page(60, 50)


def q_page_genre_indexed(spark, sf):
    """A deep page of one genre, whatever its spelling's case."""
    return _clustered(spark, sf, "idx_genre").page(9, 40, genre="medium", collation="UNICODE_CI_AI")


def q_page_meta_indexed(spark, sf):
    return _clustered(spark, sf, "idx_genre").page_meta(1, 30, genre="MEDIUM")


def q_tracks_rank_indexed(spark, sf):
    """Best-ranked tracks of a genre: only files whose ranks reach low enough are opened."""
    return _clustered(spark, sf, "idx_genre").scan(equals={"genre": "SMALL"}, at_most={"rank_in_genre": 40}, at_least={"popularity": 50})


def q_tracks_artist_indexed(spark, sf):
    return _clustered(spark, sf, "idx_artist").scan(equals={"artist_name": "Supplier#000000002"})


# ---------------------------------------------------------------- generic shapes
def q_rank_part_price(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    # prices are 2-decimal values in a bounded range: the histogram stays small
    return rank_by_histogram(part, ["p_type"], "p_retailprice", name="price_rank")


SLICE_TEST_ROWS = 64          # small bound, so that groups of the test tables are cut


def q_lag_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return lag_by_range(ev, ["user_id"], ["ts", "event_id"], "value", "prev_value", max_group_rows=SLICE_TEST_ROWS)


def q_rank_order_price(spark, sf):
    """Ranks on a many-valued key: three statuses hold all orders."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rank_by_range(orders, ["o_orderstatus"], "o_totalprice", name="price_rank", max_group_rows=SLICE_TEST_ROWS * 8)


def q_rank_quantity(spark, sf):
    """Ranks with few values and massive ties, cut all the same."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return rank_by_range(li, ["l_returnflag"], "l_quantity", descending=False, name="quantity_rank", max_group_rows=SLICE_TEST_ROWS * 16)


def q_orders_stats(spark, sf):
    """The grouped-statistics operator on another table: orders by status and
    priority with exact average price and the largest order per group."""
    from strata.operators.aggregate import best_by, group_stats
    orders = table(spark, sf, "orders")
    return group_stats(orders, ["o_orderstatus", "o_orderpriority"], averages={"o_totalprice": 2},
                       count_of="o_orderkey", count_name="n_orders",
                       extra=[best_by("o_orderkey", "o_totalprice", tie_break=["o_orderkey"])
                              .alias("top_order")])


def q_distinct_priority(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority").distinct()


def q_page_customers(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return page(cust, [F.col("c_acctbal").desc_nulls_last()], ["c_custkey"], 2, 100)


def q_page_customers_meta(spark, sf):
    cust = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return page_meta(cust, 1, 75)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
