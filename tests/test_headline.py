from pyspark.sql import functions as F

from strata.plans import headline, marts
from strata.session import scratch_path
from strata.sinks.runs import RunStore


def tracks(spark):
    return spark.range(5000).selectExpr(
        "if(id % 11 = 0, null, concat('G', id % 5)) as genre", "cast(1990 + id % 9 as int) as year",
        "cast(if(id % 13 = 0, null, id * 37 % 101) as int) as popularity", "if(id % 17 = 0, null, id * 0.37 - 300) as tempo")


def test_any_selection_equals_the_full_scan(spark):
    df = tracks(spark)
    store = RunStore(spark, scratch_path(spark, "headline"))
    for day in range(3):
        headline.add_run(store, f"d{day}", df.filter(F.pmod(F.xxhash64("tempo", "popularity"), F.lit(3)) == day))
    headline.add_run(store, "d1", df.filter(F.pmod(F.xxhash64("tempo", "popularity"), F.lit(3)) == 1))     # landed again
    parts = store.read(headline.TABLE)
    assert parts.count() <= 3 * 6 * 9
    for genres, years in ((["G1", "g3"], (1991, 1996)), (["G0"], (1990, 1990)), (["none"], (1990, 1999)), ([], (1990, 1999))):
        assert headline.summary(parts, genres, years).collect() == marts.summary(df, genres, years).collect()
        assert headline.popularity_by_genre(parts, genres, years).collect() == marts.popularity_by_genre(df, genres, years).collect()


def test_a_day_is_added_without_reading_the_others(spark):
    store = RunStore(spark, scratch_path(spark, "headline"))
    headline.add_run(store, "d0", tracks(spark))
    before = set(store.read(headline.TABLE).inputFiles())
    headline.add_run(store, "d1", tracks(spark).limit(100))
    assert before < set(store.read(headline.TABLE).inputFiles())


def test_odd_values_win_as_in_a_plain_average(spark):
    df = spark.createDataFrame([("G1", 1990, 5, float("inf")), ("G1", 1991, 6, 2.0), ("G2", 1990, None, None)],
                               "genre string, year int, popularity int, tempo double")
    got = headline.summary(headline.partials(df), ["G1", "G2"], (1990, 1991)).first()
    assert got == marts.summary(df, ["G1", "G2"], (1990, 1991)).first() and got["avg_tempo"] == float("inf")
