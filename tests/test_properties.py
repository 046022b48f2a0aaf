"""Property tests: the skew-safe operators equal their plain definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.quality import dedup_by_key
from strata.operators.ranking import lag_within, rank_by_histogram, rank_within
from tests.conftest import rows

ROW = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5)),
                st.one_of(st.none(), st.integers(1990, 1993)))
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, data):
    return spark.createDataFrame([(f"{i:04d}", g, v, y) for i, (g, v, y) in enumerate(data)],
                                 "id string, g string, v int, y int")


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=40), st.booleans())
def test_histogram_rank_is_rank(spark, data, desc):
    df = _frame(spark, data)
    a = rank_within(df, ["g"], "v", descending=desc, name="r")
    b = rank_by_histogram(df, ["g"], "v", descending=desc, name="r")
    assert rows(a, "id", "r") == rows(b, "id", "r")


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=40), st.integers(0, 3))
def test_blocked_lag_is_lag(spark, data, bound):
    df = _frame(spark, data)
    plain = lag_within(df, ["g"], ["y", "id"], "v", "prev")
    # blocks must never decrease along (y, id): y itself and a prefix of the padded id
    blocked = lag_within(df, ["g"], ["y", "id"], "v", "prev",
                         blocks=[F.col("y"), F.substring("id", 1, 3)], max_group_rows=bound)
    assert rows(plain, "id", "prev") == rows(blocked, "id", "prev")


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=40))
def test_dedup_keeps_smallest_row(spark, data):
    df = _frame(spark, data).select("g", "v", "y")
    got = {r["g"]: (r["v"], r["y"]) for r in dedup_by_key(df, "g", ["v", "y"]).collect()}

    def key(t):  # ascending, nulls first
        return tuple((x is not None, x if x is not None else 0) for x in t)

    want = {}
    for g, v, y in data:
        if g not in want or key((v, y)) < key(want[g]):
            want[g] = (v, y)
    assert got == want
