import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import curriculum, decontaminate, hilbert, toxicity
from tests.llm.helpers import CLASHING, SF, documents, edge_docs, empty_docs, write_tables
from tests.llm.test_minhash import brute

BENCH, LABELS = "item_id long, text string", "doc_id long, quality int, toxic int"


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_run_equals_its_parts_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in documents(spark).collect()}
    scores = toxicity.op8_toxicity_lexicon(spark, SF).collect()
    left = {r["doc_id"] for r in scores if not r["predicted"]}
    roots = brute([(k, rows[k]["text"]) for k in sorted(left)], 5)
    left = {k for k in left if roots[k] == k}
    hit = {r["doc_id"] for r in decontaminate.op6_decontaminate(spark, SF).collect() if r["contaminated"]}
    left -= hit
    plan = curriculum.plan_mix(spark.createDataFrame([rows[k] for k in sorted(left)], documents(spark).schema)).collect()
    want = sorted(r["doc_id"] for r in plan for _ in range(r["copies"]))
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == want and len(left) < 200
    sizes = [sum(r["shard"] == s for r in out) for s in range(hilbert.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    assert all(r["text"] == rows[r["doc_id"]]["text"] for r in out)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return write_tables(
        spark, tmp_path_factory.mktemp("pipeline"), documents=edge_docs(spark, extra=True),
        benchmark=spark.createDataFrame([(1, "same key"), (2, None)], BENCH),
        labels=spark.createDataFrame([(1, 1, 0), (8, 0, 1), (4, None, None), (None, 1, 1)], LABELS))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, folder, name, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(spark, docs, folder)
    if name != "sharding":
        assert out.columns == docs.columns
    rows = out.collect()
    clash = [c for c in CLASHING if c in out.columns]
    assert clash and all(r[c] == f"mine {c}" for r in rows for c in clash)
    kept = {r["doc_id"] for r in rows}
    if name in ("toxicity", "sharding"):
        assert len(rows) == 14 or name == "toxicity"
    if name == "near_duplicates":
        assert 1 in kept and not kept & {2, 3}
    if name == "decontamination":
        assert 10 not in kept and len(rows) == 12
    assert stage(spark, empty_docs(spark), folder).collect() == []


def test_rows_repeat_as_the_mix_says(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = curriculum.plan_mix(docs.drop("size", "target"))
    want = plan.agg(F.sum("copies")).first()[0]
    assert dict(corpus_pipeline.STAGES)["mixing"](spark, docs, folder).count() == want
