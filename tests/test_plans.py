"""Physical-plan properties the operators are designed for (regression guards)."""

import re

from strata import registry as R
from strata.plans import silver
from tests.conftest import SF_SMALL, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def test_window_top_n_limits_before_the_shuffle(spark):
    from strata.operators.ranking import top_n
    p = _plan(top_n(R.silver_rows(spark, SF_SMALL), ["genre", "year"], "popularity", 10,
                    name="rank_in_year"))
    assert "Partial" in p and "Final" in p
    # the partial limit sits below (after, in the text) the hash exchange on the window keys
    ex = re.search(r"Exchange hashpartitioning\(genre#\d+, year#\d+", p)
    assert ex and p.rfind("WindowGroupLimit") > ex.start()


def test_hits_mart_is_a_broadcast_filter_without_window(spark):
    p = _plan(R.q_dm_hits(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "Window" not in p and "Exchange hashpartitioning" not in p


def test_fused_split_dedup_is_one_shuffle_and_no_join(spark):
    p = _plan(R.q_silver_unified(spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "SortMergeJoin" not in p and "partial_min" in p


def test_two_source_unify_reuses_dedup_partitioning(spark):
    cat, aud = R.sources(spark, SF_SMALL)
    p = _plan(silver.unify(silver.check_sources(cat, aud)))
    assert "SortMergeJoin" in p
    # one exchange per source (the dedup); the join adds none
    assert len(re.findall(r"Exchange hashpartitioning\(track_id", p)) == 2


def test_histogram_rank_broadcasts_small_histogram(spark):
    p = _plan(R.q_rank_in_genre(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "Window [rank(" not in p


def test_scan_pushdown_and_pruning(spark):
    df = R.q_page_customers_meta(spark, SF_SMALL)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in p
    assert "ReadSchema: struct<c_mktsegment:string>" in p


def test_split_path_equals_two_source_path(spark):
    fused = R.checked(spark, SF_SMALL)
    cat, aud = R.sources(spark, SF_SMALL)
    general = silver.check_sources(cat, aud)
    assert rows(silver.unify(fused)) == rows(silver.unify(general))
    assert rows(silver.dq_report(fused)) == rows(silver.dq_report(general))
