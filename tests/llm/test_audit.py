import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strata.llm import audit
from tests.llm.helpers import SF, edge_docs, empty_docs, words, write_tables
from tools.compare import compare_one, duck


def brute(rows, labels):
    """The audit from the definitions; rows: (key, text, lang), labels: key -> (good, toxic)."""
    big = 1 << 63
    docs = []
    for key, text, lang in rows:
        t = text or ""
        w = words(t)
        smaller = any((k if k is not None else big) < (key if key is not None else big) for k, u, _ in rows if (u or "") == t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": smaller}
        docs.append((lang or "", {f for f, v in fails.items() if v}, labels.get(key, (0, 0))))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                left = [d for d in own if not d[1] & set(order[:k])]
                gone = [d for d in left if f in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left) - len(gone), len(gone), sum(f in d[1] and bool(d[1] & set(order[:k])) for d in own),
                    sum(d[1] == {f} for d in own), sum(d[2][0] for d in gone), sum(d[2][1] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


def test_query_equals_oracle(spark):
    got = compare_one(spark, duck(SF), "op12_filter_audit", SF, audit.QUERIES, audit.ORACLE)
    assert got["status"] == "ok", got


@pytest.mark.parametrize("cells, limit", [(16, 64 << 20), (0.01, 64 << 20), (16, 0)])   # a full sketch, and the shuffled join
def test_edges_equal_brute_force(spark, tmp_path, monkeypatch, cells, limit):
    monkeypatch.setattr(audit, "CELLS", cells)
    monkeypatch.setattr(audit, "BROADCAST_BYTES", limit)
    docs = edge_docs(spark, extra=True)
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (9, None, 1), (None, 1, 1), (77, 1, 1)]
    folder = write_tables(spark, tmp_path, documents=docs, labels=spark.createDataFrame(labels, LABELS))
    want = brute([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], {1: (1, 1), 2: (1, 0), 9: (0, 1)})
    assert result(audit.op12_filter_audit(spark, folder)) == want


def test_repeats_of_one_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(5, "text 4"), (None, "hot"), (None, "alone"), (None, "alone")], "doc_id long, text string"))
    got = audit.mark_repeats(docs, keep=["doc_id", "text"]).collect()
    assert len(got) == 3004
    assert {(r["doc_id"], r["text"]) for r in got if r["repeat"]} == (
        {(i, "hot") for i in range(3, 3000, 3)} | {(5, "text 4"), (None, "hot")})


def test_sketch_clears_nearly_all_unique_texts(spark):
    docs = spark.range(20_000).select(F.xxhash64("id").alias("_h"))
    blocks = 20_000 * audit.CELLS // 64
    cells = audit.repeated_cells(docs, "_h", blocks)
    rows = docs.withColumns(audit._probes("_h", blocks)).join(cells, "_block")
    assert rows.filter("_repeated & _bits = _bits").count() < 400


def test_empty(spark, tmp_path):
    folder = write_tables(spark, tmp_path, documents=empty_docs(spark), labels=spark.createDataFrame([], LABELS))
    assert audit.op12_filter_audit(spark, folder).collect() == []
