import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate
from tests.llm.helpers import SF, edge_docs, empty_docs, write_tables
from tools.compare import compare_one, duck

BENCH = "item_id long, text string"


@pytest.mark.parametrize("sent", [64 << 20, -1])
def test_query_matches_oracle_with_and_without_broadcast(spark, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", sent)
    res = compare_one(spark, duck(SF), "op6_decontaminate", SF, decontaminate.QUERIES, decontaminate.ORACLE)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("sent", [64 << 20, -1])
def test_short_items_overlaps_and_normalisation(spark, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", sent)
    bench = spark.createDataFrame([
        (1, "Alpha, BETA gamma"), (2, "one two three four five six seven eight nine ten eleven"), (3, None), (4, "  "),
        (12, "beta"), (5, "ÉTÉ")], BENCH)
    docs = spark.createDataFrame([
        (1, "x alpha-beta_gamma y"), (2, "0 one two three four five six seven eight nine ten eleven 12"),
        (3, "one two three four five six seven eight nine"), (4, None), (5, "été ÉTÉ")], "doc_id long, text string")
    got = {int(r["_key"]): (r["n_hit"], r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (3, ["1", "12"]), 2: (11, ["2"]), 5: (1, ["5"])}
    kept = decontaminate.decontaminate(docs, bench).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 4]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench, mode="spans").collect()}
    assert cut == {1: "x y", 2: "0 12", 3: "one two three four five six seven eight nine", 4: None, 5: "été "}


def test_edges(spark, tmp_path):
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True), benchmark=spark.createDataFrame(
        [(1, "same key"), (2, "word"), (2, "word")], BENCH))
    rows = decontaminate.op6_decontaminate(spark, folder).collect()
    assert sorted((r["doc_id"] or 0) for r in rows if r["contaminated"]) == [8, 10, 10]
    docs, bench = edge_docs(spark, extra=True), spark.createDataFrame([], BENCH)
    assert decontaminate.decontaminate(docs, bench).count() == 14
    kept = decontaminate.decontaminate(docs, spark.createDataFrame([(1, "word")], BENCH))
    assert kept.columns == docs.columns and kept.count() == 13 and kept.filter(F.col("key") != "mine key").count() == 0
    assert decontaminate.decontaminate(empty_docs(spark), bench).collect() == []


def test_the_query_reads_each_text_once(spark, tmp_path):
    """One scan gives words and hits; rows that come twice stay two, hit or not."""
    docs = [(1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (2, "A"), (3, None), (3, "x a")]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame(docs, "doc_id long, text string"),
                          benchmark=spark.createDataFrame([(7, "a"), (8, "a b")], BENCH))
    df = decontaminate.op6_decontaminate(spark, folder)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
    got = sorted(((r["doc_id"] or 0), r["n_words"], r["n_hit"], r["n_items"]) for r in df.collect())
    assert got == [(0, 1, 0, 0), (0, 1, 0, 0), (1, 2, 2, 2), (1, 2, 2, 2), (2, 1, 1, 1), (3, 0, 0, 0), (3, 2, 1, 1)]
