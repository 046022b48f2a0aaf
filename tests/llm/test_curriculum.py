import pytest
from pyspark.sql import functions as F

from strata.llm import curriculum
from tests.llm.helpers import SF, documents, edge_docs, edge_rows, empty_docs, words, write_tables
from tools.compare import compare_one, duck


def test_query_matches_oracle(spark):
    name = "op10_curriculum_mix"
    res = compare_one(spark, duck(SF), name, SF, curriculum.QUERIES, curriculum.ORACLE)
    assert res["status"] == "ok", res


def test_taken_words_come_near_targets(spark):
    rows = curriculum.plan_mix(documents(spark)).select("source", "size", "source_size", "target", "taken", "copies").collect()
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2 for r in own)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: 2 * sizes[s] for s in full} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_excess_is_shared_again(spark, tmp_path):
    sizes = {"a": 3, "b": 4, "c": 100, "d": 50, "é": 7, None: 30, "": 2}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    got = curriculum.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["source"]: r["target"] for r in got} == pytest.approx(brute_targets(sizes))


def test_due_inverts_demand(spark):
    for a in (-0.9, -0.5, 0.0, 0.5, 0.9):
        rows = spark.range(101).select((F.col("id") / 100).alias("t")).withColumn(
            "back", curriculum.due(F.col("t") + a * (F.col("t") * F.col("t") - F.col("t")), F.lit(a))).collect()
        assert all(r["back"] == pytest.approx(r["t"], abs=1e-9) for r in rows)


def test_training_order_follows_the_schedule(spark):
    """A source whose demand rises has fewer words due in the first half than one that falls."""
    ordered = curriculum.training_order(curriculum.plan_mix(documents(spark))).select("source", "size", "position").collect()
    assert all(0 <= r["position"] <= 1 for r in ordered)
    sources = sorted({r["source"] for r in ordered})
    early = {s: sum(r["size"] for r in ordered if r["source"] == s and r["position"] < 0.5)
             / sum(r["size"] for r in ordered if r["source"] == s) for s in sources}
    rising, falling = [early[s] for s in sources[0::3]], [early[s] for s in sources[2::3]]
    assert sum(rising) / len(rising) < 0.45 < 0.55 < sum(falling) / len(falling)


def test_edges(spark, tmp_path):
    docs = edge_docs(spark, extra=True)
    folder = write_tables(spark, tmp_path, documents=docs)
    rows = curriculum.op10_curriculum_mix(spark, folder).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for _, t, *_ in edge_rows())
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert curriculum.op10_curriculum_mix(spark, folder).exceptAll(curriculum.op10_curriculum_mix(spark, folder)).count() == 0
    assert curriculum.plan_mix(empty_docs(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"]) for r in curriculum.plan_mix(blank).collect()} == {(0.0, 0)}
