import pytest
from pyspark.sql import functions as F

from strata.functions import exact_avg, guarded_int, hash_key, round_half_up, strip_ws
from strata.functions.predicates import all_of, contains_text, in_list


def test_strip_all_unicode_whitespace(spark):
    vals = [" a ", "\tb ", "　c\r", "\x1cd\x1f", " e ", "  ", "x y"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(strip_ws("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_hash_key_matches_md5_prefix_and_collides_without_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "n string, a string")
    got = [r[0] for r in df.select(hash_key("n", "a")).collect()]
    assert got == ["900150983cd24fb0", "900150983cd24fb0"]
    sep = [r[0] for r in df.select(hash_key("n", "a", separator="|")).collect()]
    assert sep[0] != sep[1]


def test_guarded_int_year_and_duration(spark):
    years = ["999", "1000", "9999", "10000", "19x9", "", None, " 2001 "]
    df = spark.createDataFrame([(y,) for y in years], "y string")
    got = [r[0] for r in df.select(guarded_int("y", 1000, 9999)).collect()]
    assert got == [None, 1000, 9999, None, None, None, None, 2001]
    durs = ["210000\r", "-5", "", "99999999999", "42"]
    df = spark.createDataFrame([(d,) for d in durs], "d string")
    got = [r[0] for r in df.select(guarded_int("d")).collect()]
    assert got == [210000, None, None, None, 42]


def test_round_half_up_mirrors_sign(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.125,), (None,), (1.0049,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [2.5, -2.5, 0.13, -0.13, None, 1.0]
    got0 = [r[0] for r in df.select(round_half_up("x", 0)).collect()]
    assert got0[:2] == [3.0, -3.0]


def test_exact_avg_is_partition_independent(spark):
    data = [(i % 7, (i * 0.0137) % 1.0) for i in range(5000)]
    df = spark.createDataFrame(data, "g int, x double")

    def result(d):
        return sorted(d.groupBy("g").agg(exact_avg("x", 4).alias("a")).collect())

    base = result(df)
    for n in (1, 7, 64):
        assert result(df.repartition(n)) == base


def _avg(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.agg(exact_avg("x", digits).alias("a")).first()["a"]


def test_exact_avg_keeps_fine_digits_and_rounds_halves_up(spark):
    assert _avg(spark, [0.00006, 0.00002], 4) == 0.0
    assert _avg(spark, [1.0] * 199 + [2.0], 2) == 1.01             # 1.005
    assert _avg(spark, [-1.0] * 199 + [-2.0], 2) == -1.01
    assert _avg(spark, [1e-7, 3e-7], 7) == 2e-7
    ints = spark.createDataFrame([(1,)] * 199 + [(2,)], "x int")
    assert ints.agg(exact_avg("x", 2, integral=True).alias("a")).first()["a"] == 1.01


def test_exact_avg_gives_nan_and_infinity_as_an_average_does(spark):
    nan, inf = float("nan"), float("inf")
    assert _avg(spark, [nan, 100.0], 2) != _avg(spark, [nan, 100.0], 2)
    assert _avg(spark, [inf, 1.0], 2) == inf
    assert _avg(spark, [inf, -inf], 2) != 0.0


def test_exact_avg_equals_spark_where_that_is_unambiguous(spark):
    data = [(i % 5, i * 0.125) for i in range(64)]                 # sums of eighths are exact
    df = spark.createDataFrame(data, "g int, x double")
    got = df.groupBy("g").agg(exact_avg("x", 3).alias("a"), F.round(F.avg("x"), 3).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_exact_avg_all_null_is_null(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "g int, x double")
    assert df.groupBy("g").agg(exact_avg("x", 2).alias("a")).collect()[0]["a"] is None


def test_optional_conjunction_and_in_list(spark):
    df = spark.createDataFrame([(1, "Café"), (2, "cafe"), (3, "100%_x")], "id int, name string")
    assert all_of(None, None) is None
    c = all_of(None, F.col("id") > 1)
    assert df.filter(c).count() == 2
    assert df.filter(in_list("id", [])).count() == 0
    assert df.filter(in_list("id", [1, 3])).count() == 2
    # text is literal: % and _ are not wildcards
    assert df.filter(contains_text("name", "%_")).count() == 1
    assert df.filter(contains_text("name", "0%x")).count() == 0
    # case/accent-insensitive collation
    assert df.filter(contains_text("name", "CAFE", "UNICODE_CI_AI")).count() == 2
    assert df.filter(contains_text("name", "CAFE")).count() == 0


def test_collated_equality_and_in_list(spark):
    from strata.functions.predicates import equals_text
    df = spark.createDataFrame([("Pop",), ("pöp",), ("rock",), ("ROCK",)], "g string")
    ci = "UNICODE_CI_AI"
    assert df.filter(equals_text("g", "POP", ci)).count() == 2
    assert df.filter(equals_text("g", "Pop")).count() == 1
    assert df.filter(in_list("g", ["pop", "rock"], ci)).count() == 4
    assert df.filter(in_list("g", ["pop", "rock"])).count() == 1
    assert df.filter(in_list("g", [], ci)).count() == 0


@pytest.mark.parametrize("rows", [1, 2_001, 20_001, 200_001])
@pytest.mark.parametrize("sign", [1, -1])
def test_averages_are_rounded_once(spark, rows, sign):
    """Means just below a half of the last digit: rounding to six digits first would lift them."""
    from fractions import Fraction
    from strata.functions.exact import exact_avg
    ones = rows // 200
    df = spark.range(rows).select((sign * (F.col("id") < ones).cast("int")).alias("n"))
    df = df.withColumn("x", F.col("n") / F.lit(8.0) + sign * 1e-12)
    got = df.agg(exact_avg("n", 2, integral=True).alias("a"), exact_avg("n", 2).alias("b"), exact_avg("n", 0, integral=True).alias("c"),
                 exact_avg("x", 4).alias("d"), exact_avg(F.col("n") * 10 ** 9, 6, integral=True).alias("e")).first()

    def half_up(total, digits):
        q = 10 ** digits * abs(Fraction(total)) / rows
        return sign * int(q + Fraction(1, 2)) / 10 ** digits

    assert got["a"] == got["b"] == half_up(ones, 2) and got["c"] == half_up(ones, 0)
    assert got["d"] == half_up(Fraction(ones, 8) + Fraction(rows, 10 ** 12), 4)
    assert got["e"] == half_up(ones * 10 ** 9, 6)


def test_averages_of_odd_values_and_wide_sums(spark):
    from strata.functions.exact import exact_avg
    df = spark.sql("select * from values (1, double('nan'), 1L, null), (1, 2.0d, 2L, null), (2, double('inf'), 9000000000000000000L, null), "
                   "(3, 1e20d, -5L, null), (3, 123456789.123456789012d, -4L, null) as t(g, x, n, e)")
    got = {r["g"]: r for r in df.groupBy("g").agg(exact_avg("x", 4).alias("x"), exact_avg("n", 0, integral=True).alias("n"),
                                                  exact_avg(F.col("e").cast("double"), 2).alias("e")).collect()}
    assert got[1]["x"] != got[1]["x"] and got[2]["x"] == float("inf") and got[3]["x"] == pytest.approx(50000000000061728394.5617, rel=1e-15)
    assert [got[g]["n"] for g in (1, 2, 3)] == [2.0, 9e18, -5.0] and got[1]["e"] is None


def test_merged_sums_give_the_same_mean(spark):
    from strata.functions.exact import exact_avg, exact_sum, rounded_mean
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.37 - 100).alias("x"))
    parts = df.groupBy("g").agg(exact_sum("x").alias("s"), F.count("x").alias("n"))
    merged = parts.agg(rounded_mean(F.sum("s").cast("decimal(38,12)"), F.sum("n"), 4).alias("m")).first()["m"]
    assert merged == df.agg(exact_avg("x", 4).alias("m")).first()["m"]
