from pyspark.sql import functions as F

from strata.operators.quality import Rule, dedup_by_key, first_failure, validate
from strata.plans import silver
from tests.conftest import rows


def test_keys_r1_r2_and_report(spark):
    df = spark.createDataFrame(
        [(None, 1, 5.0), ("", 2, 1.0), ("a", 3, 2.0), ("a", 1, 9.0), ("a", 1, 3.0), ("b", 7, None)],
        "k string, x int, y double")
    rules = [Rule(3, "x_small", lambda: F.col("x") <= 5), Rule(4, "y_present", lambda: F.col("y").isNotNull())]
    v = validate(df, "t", "k", rules, ["x", "y"])
    # smallest (x, y) kept per key: ("a", 1, 3.0)
    assert rows(v.kept) == [("a", 1, 3.0)]
    rep = {r["rule"]: (r["rows_in"], r["rejected"], r["rows_out"]) for r in v.report.collect()}
    assert rep["R1_key_not_blank"] == (6, 2, 4)
    assert rep["R2_unique_key"] == (4, 2, 2)
    assert rep["x_small"] == (2, 1, 1)       # b has x=7
    assert rep["y_present"] == (1, 0, 1)
    for rin, rej, out in rep.values():
        assert rin - rej == out


def test_dedup_nulls_sort_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", None), ("a", 1)], "k string, x int")
    assert rows(dedup_by_key(df, "k", ["x"])) == [("a", None)]


def test_range_rules_edges(spark):
    pops = [(-1,), (0,), (100,), (101,), (None,)]
    df = spark.createDataFrame([(str(i), p[0], 0.5, 0.5) for i, p in enumerate(pops)],
                               "track_id string, popularity int, danceability double, energy double")
    tagged = {r["popularity"]: r["failed_rule"] for r in first_failure(df, silver.AUDIO_RULES).collect()}
    assert tagged == {-1: "R3_popularity_range", 0: None, 100: None, 101: "R3_popularity_range",
                      None: "R3_popularity_range"}
    dance = [0.0, 1.0, 1.0001, None]
    df = spark.createDataFrame([(str(i), 50, d, 0.5) for i, d in enumerate(dance)],
                               "track_id string, popularity int, danceability double, energy double")
    tagged = {r["danceability"]: r["failed_rule"] for r in first_failure(df, silver.AUDIO_RULES).collect()}
    assert tagged == {0.0: None, 1.0: None, 1.0001: "R4_unit_range", None: "R4_unit_range"}
    durs = [30000, 30001, None]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(durs)], "track_id string, duration_ms int")
    tagged = {r["duration_ms"]: r["failed_rule"] for r in first_failure(df, silver.CATALOGUE_RULES).collect()}
    assert tagged == {30000: "R5_min_duration", 30001: None, None: "R5_min_duration"}


def test_dq_report_balances_on_driver_data(spark):
    from strata.registry import checked
    rep = silver.dq_report(checked(spark, "/root/testdata/sf0.001")).collect()
    by = {(r["source"], r["rule"]): r for r in rep}
    assert by[("audio_features", "R2_unique_key")]["rejected"] == 4095
    assert by[("audio_features", "R3_popularity_range")]["rejected"] == 76
    assert by[("audio_features", "R4_unit_range")]["rejected"] == 17
    assert by[("catalogue", "R5_min_duration")]["rejected"] == 158
    assert by[("audio_features", "R6_key_in_catalogue")]["rejected"] == 147
    assert by[("catalogue", "R5_min_duration")]["rows_out"] == 1747
    assert by[("audio_features", "R6_key_in_catalogue")]["rows_out"] == 1665


def test_dedup_hot_key_third_of_rows(spark):
    n = 3000
    data = [("hot" if i % 3 == 0 else f"k{i}", (i * 7919) % 1000, float(i % 13)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, x int, y double").repartition(16)
    out = {r["k"]: (r["x"], r["y"]) for r in dedup_by_key(df, "k", ["x", "y"]).collect()}
    hot = sorted((x, y) for k, x, y in data if k == "hot")[0]
    assert out["hot"] == hot
    assert len(out) == 1 + sum(1 for i in range(n) if i % 3)
