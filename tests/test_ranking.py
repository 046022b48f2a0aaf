import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.ranking import (
    lag_by_range, lag_within, range_slices, rank_by_histogram, rank_by_range, rank_within, top_n,
)
from strata.session import materialize
from tests.conftest import rows


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one group holds about a third of all rows
        g = rnd.choice(["a", "b", "c", None]) if rnd.random() > 0.34 else "hot"
        v = rnd.choice([None] + list(range(20))) if rnd.random() > 0.02 else None
        year = rnd.choice([None, 1999, 2000, 2001, 2002])
        data.append((f"{i:05x}{rnd.randrange(16**6):06x}", g, v, year))
    return spark.createDataFrame(data, "id string, g string, v int, year int")


def test_histogram_rank_equals_window_rank(spark):
    df = _data(spark)
    a = rank_within(df, ["g"], "v", name="r")
    for limit in ("10m", "-1"):  # broadcast and shuffle join, as Catalyst chooses
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            b = rank_by_histogram(df, ["g"], "v", name="r")
            assert rows(a, "id", "r") == rows(b, "id", "r")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    asc_a = rank_within(df, ["g"], "v", name="r", descending=False)
    asc_b = rank_by_histogram(df, ["g"], "v", name="r", descending=False)
    assert rows(asc_a, "id", "r") == rows(asc_b, "id", "r")


def test_blocked_lag_equals_plain_lag(spark):
    df = _data(spark)
    plain = lag_within(df, ["g"], ["year", "id"], "v", "prev")
    for blocks in ([F.col("year")], [F.col("year"), F.substring("id", 1, 2)], [F.substring("id", 1, 1)]):
        blocked = lag_within(df, ["g"], ["year", "id"], "v", "prev", blocks=blocks)
        assert rows(plain, "id", "prev") == rows(blocked, "id", "prev")


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(f"t{i}", "pop", 2000, 80) for i in range(12)]
                               + [("x", "pop", 2000, 10)], "id string, g string, y int, p int")
    out = top_n(df, ["g", "y"], "p", 10, name="rank_in_year")
    assert out.count() == 12
    assert {r["rank_in_year"] for r in out.collect()} == {1}


def test_lag_size_check_picks_a_form_with_equal_results(spark):
    df = _data(spark)
    plain = lag_within(df, ["g"], ["year", "id"], "v", "prev")
    for limit in (0, 700, 10**9):   # all groups blocked, only "hot" blocked, plain window
        out = lag_within(df, ["g"], ["year", "id"], "v", "prev", blocks=[F.col("year")],
                         max_group_rows=limit)
        assert rows(plain, "id", "prev") == rows(out, "id", "prev")


def test_enrich_blocked_lag_matches(spark):
    from strata import registry as R
    from strata.plans import silver
    u = R.unified(spark, "/root/testdata/sf0.001")
    a = silver.enrich(u, lag_window_max_rows=None)
    b = silver.enrich(u)
    assert rows(a) == rows(b)


def test_top_n_histogram_equals_window(spark):
    df = _data(spark)
    for n in (1, 3, 10):
        a = top_n(df, ["g", "year"], "v", n, name="r")
        b = top_n(df, ["g", "year"], "v", n, name="r", method="histogram")
        assert rows(a, "id", "r") == rows(b, "id", "r")


def test_rank_goes_beyond_an_int(spark):
    """Weighted counts stand for rows: the rank of the next level passes 2^31."""
    from strata.operators.ranking import rank_by_histogram
    df = spark.createDataFrame([("g", 5), ("g", 4)], "g string, v int")
    assert dict(rank_by_histogram(df, ["g"], "v", name="r").dtypes)["r"] == "bigint"
    many = spark.range(2_300_000_000).select(F.lit("g").alias("g"), F.lit(5).alias("v"))
    one = spark.createDataFrame([("g", 4)], "g string, v int")
    hist = many.groupBy("g", "v").count().unionByName(one.withColumn("count", F.lit(1)))
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select("v", (F.coalesce(F.sum("count").over(w), F.lit(0)) + 1).alias("r")).collect()
    assert {r["v"]: r["r"] for r in ranks} == {5: 1, 4: 2_300_000_001}


def ranked_pairs(df, name):
    return sorted((tuple(r) for r in df.select("id", "g", "v", name).collect()), key=repr)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("values", ["id * 7919 % 1000003", "id % 3", "if(id % 3 = 0, null, id % 50)", "5"])
def test_rank_by_range_equals_rank(spark, descending, values):
    """Many values, few, nulls and a single one; one group holds two thirds of all rows, one none has a name."""
    df = spark.range(3000).selectExpr("id", "case when id % 3 > 0 then 'hot' when id % 2 = 0 then null else concat('g', id % 40) end as g",
                                      f"{values} as v")
    df = materialize(df.repartition(5))
    for rows in (150, 10_000):
        got = rank_by_range(df, ["g"], "v", descending=descending, max_group_rows=rows)
        assert ranked_pairs(got, "rank") == ranked_pairs(rank_within(df, ["g"], "v", descending=descending), "rank")


def test_slices_of_large_groups_are_bounded(spark):
    df = materialize(spark.range(20_000).selectExpr("id", "if(id % 10 = 0, id % 100, -1) as g", "id * 31 % 5003 as v"))
    sizes = range_slices(df, ["g"], [F.col("v").asc(), F.col("id").asc()], 1000).groupBy("g", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 2500 and sizes.filter("g = -1").count() >= 12
    assert sizes.filter("g >= 0 and _slice > 0").count() == 0


def test_lag_by_range_equals_lag(spark):
    """One user holds most events inside one hour; values, users and times may be null."""
    df = materialize(spark.range(4000).selectExpr(
        "id", "if(id % 4 > 0, 'hot', if(id % 8 = 0, null, concat('u', id % 60))) as g",
        "if(id % 17 = 0, null, timestamp_micros(1700000000000000 + id * 7919 % 3000 * 1000)) as ts", "if(id % 5 = 0, null, id * 3) as v"))
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy(F.col("ts").asc_nulls_first(), "id")))
    for rows in (100, 10_000):
        got = lag_by_range(df, ["g"], ["ts", "id"], "v", "p", max_group_rows=rows)
        assert got.columns == [*df.columns, "p"] and ranked_pairs(got, "p") == ranked_pairs(want, "p")


def test_slices_do_not_need_a_task_each(spark):
    """Hundreds of slices are cut by as many tasks as a shuffle has."""
    df = materialize(spark.range(20_000).selectExpr("id", "if(id % 10 = 0, null, -1) as g", "id * 31 % 5003 as v"))
    sliced = range_slices(df, ["g"], [F.col("v").asc(), F.col("id").asc()], 50)
    sizes = sliced.filter("_slice > 0").groupBy("g", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 50 and sizes.count() >= 400
    assert len(sliced.filter("_slice > 0").inputFiles()) - len(df.inputFiles()) <= 8
    cuts = sliced.groupBy("g", "_slice").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    before = Window.partitionBy("g").orderBy("_slice")
    assert cuts.withColumn("b", F.lag("high").over(before)).filter("b > low").count() == 0
    got = lag_by_range(df, ["g"], ["v", "id"], "id", "p", max_group_rows=50)
    want = df.withColumn("p", F.lag("id").over(Window.partitionBy("g").orderBy("v", "id")))
    assert ranked_pairs(got, "p") == ranked_pairs(want, "p")
