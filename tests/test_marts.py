from pyspark.sql import functions as F

from strata.operators.paging import clamp, page, page_meta
from strata.plans import marts
from tests.conftest import rows


def test_clamp():
    assert clamp(0, 0) == (1, 1)
    assert clamp(-3, 201) == (1, 200)
    assert clamp(None, None) == (1, 50)


def test_pages_partition_the_result(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(103)], "id int, v int")
    seen = []
    for p in range(1, 7):
        seen += [r["id"] for r in page(df, [F.col("v").desc()], ["id"], p, 20).collect()]
    assert sorted(seen) == list(range(103)) and len(seen) == 103
    assert page(df, [F.col("v")], ["id"], 99, 20).count() == 0
    meta = page_meta(df, 1, 20).collect()[0]
    assert (meta["total"], meta["total_pages"], meta["page_size"]) == (103, 6, 20)
    empty = page_meta(df.filter("id < 0"), 1, 20).collect()[0]
    assert (empty["total"], empty["total_pages"]) == (0, 0)


def test_empty_selection_and_year_range_default(spark):
    dm = spark.createDataFrame([("t1", "pop", 2001, 50, 120.0)], "track_id string, genre string, year int, popularity int, tempo double")
    assert marts.summary(dm, [], (1990, 2020)).collect()[0]["total_tracks"] == 0
    yr = marts.year_range(dm.filter("year < 0")).collect()[0]
    assert (yr["y_min"], yr["y_max"]) == (2000, 2023)
    yr = marts.year_range(dm).collect()[0]
    assert (yr["y_min"], yr["y_max"]) == (2001, 2001)


def test_evolution_uses_first_five_genres(spark):
    gs = ["g1", "g2", "g3", "g4", "g5", "g6", "g7"]
    dm = spark.createDataFrame([(g, 1990, 1.0, 0.1, 0.1, 1) for g in gs],
                               "genre string, decade int, avg_popularity double, avg_danceability double, "
                               "avg_energy double, nb_tracks bigint")
    assert {r["genre"] for r in marts.evolution(dm, gs).collect()} == set(gs[:5])


def test_track_filters_zero_is_a_value(spark):
    dm = spark.createDataFrame([("a", "X b", "pop", 2000, 0, 1), ("b", "y", "rock", 2001, 10, 2)],
                               "track_id string, artist_name string, genre string, year int, popularity int, rank_in_genre int")
    assert marts.tracks_filter(dm).count() == 2
    assert marts.tracks_filter(dm, min_popularity=0).count() == 2
    assert marts.tracks_filter(dm, min_popularity=1).count() == 1
    assert marts.tracks_filter(dm, artist="x").count() == 1          # default: case-insensitive
    assert marts.tracks_filter(dm, artist="x", collation="UTF8_BINARY").count() == 0
    assert marts.tracks_filter(dm, genre="POP").count() == 1
    assert marts.tracks_filter(dm, genre="POP", collation="UTF8_BINARY").count() == 0
    assert marts.tracks_filter(dm, genre="pop", year=2001).count() == 0


def test_a_page_ranked_after_it_is_cut(spark):
    """Equal to ranking all rows first: ties, a null genre and a null popularity included."""
    from strata.operators.ranking import rank_within
    df = spark.range(400).selectExpr("concat('t', lpad(id, 4, '0')) as track_id", "if(id % 7 = 0, null, concat('g', id % 4)) as genre",
                                     "cast(if(id % 31 = 0, null, id * 37 % 23) as int) as popularity")
    ranked = rank_within(df, ["genre"], "popularity", name="rank_in_genre")
    for p in (1, 4, 8, 9):
        got = marts.tracks_page_ranked(df, page_no=p, page_size=50)
        assert got.collect() == marts.tracks(ranked, page_no=p, page_size=50).collect()
    assert (marts.tracks_page_ranked(df, genre="G2", page_size=20, collation="UNICODE_CI_AI").collect()
            == marts.tracks(ranked, genre="g2", page_size=20).collect())
