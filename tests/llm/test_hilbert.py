import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import hilbert
from tests.llm.helpers import SF, documents, edge_docs, edge_rows, empty_docs, write_tables
from tools.compare import compare_one, duck


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(spark, n, bits):
    side = 1 << bits
    cells = spark.range(side ** n).select(*[
        (F.floor(F.col("id") / side ** j) % side).cast("int").alias(f"c{j}") for j in range(n)])
    rows = cells.withColumn("h", hilbert.curve_index([F.col(f"c{j}") for j in range(n)], bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(side ** n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[j] - b[j]) for j in range(n)) == 1


def test_query_matches_oracle(spark):
    res = compare_one(spark, duck(SF), "op1_hilbert_shards", SF, hilbert.QUERIES, hilbert.ORACLE)
    assert res["status"] == "ok", res


def check(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_query_gives_sizes_digests_and_equal_shards(spark):
    rows = hilbert.op1_hilbert_shards(spark, SF).collect()
    check(rows, hilbert.SHARDS)
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "rows")
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_edges(spark, tmp_path):
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True))
    rows = hilbert.op1_hilbert_shards(spark, folder).collect()
    check(rows, hilbert.SHARDS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16) for d, t, *_ in edge_rows())
    assert hilbert.hilbert_shards(empty_docs(spark), hilbert.DIMS, 5).collect() == []


def test_shards_prune_each_dimension(spark):
    out = hilbert.hilbert_shards(documents(spark), hilbert.DIMS, 8, ties=["doc_id"])
    manifest = hilbert.shard_manifest(out, ["n_chars"]).collect()
    whole = max(r["max_n_chars"] for r in manifest) - min(r["min_n_chars"] for r in manifest)
    assert sum(r["max_n_chars"] - r["min_n_chars"] < whole / 2 for r in manifest) >= 4


def test_clashing_outputs_are_replaced(spark):
    docs = documents(spark).withColumns({"shard": F.lit("x"), "slot": F.lit("x"), "_part": F.lit("kept")})
    out = hilbert.hilbert_shards(docs, ["n_chars"], 4)
    assert dict(out.dtypes)["shard"] == "int" and {r["_part"] for r in out.collect()} == {"kept"}


def test_strings_are_compared_whole(spark):
    names = [f"www.example{i % 37:02}.com" for i in range(500)] + ["odd", "", None, "www.example00.com/é"] + ["hot"] * 200
    df = spark.createDataFrame([(v, f"source_{i % 90:04}") for i, v in enumerate(names)], "host string, source string")
    got = df.select("*", *[c.alias(f"c{i}") for i, c in enumerate(hilbert.quantise(df, ["host", "source"], 4))]).collect()
    for name, cell in (("host", "c0"), ("source", "c1")):
        values = sorted((r[name] for r in got if r[name] is not None), key=str.encode)
        cuts = [values[-(-len(values) * i // 16) - 1] for i in range(1, 16)]
        for r in got:
            assert r[cell] == sum(r[name] is not None and c.encode() < r[name].encode() for c in cuts)
    assert len({r["c1"] for r in got}) == 16


def test_cut_points_of_many_valued_numbers_are_order_statistics(spark):
    n = 30_000
    df = spark.range(n).selectExpr("id * 7919 % 30011 - 5000 as a", "if(id % 3 = 0, 4.5, id * 0.37) as b", "if(id % 5 = 0, null, id) as c")
    cuts = hilbert.exact_cuts(df, ["a", "b", "c"], 16, "double")
    for cut, name in zip(cuts, "abc"):
        values = sorted(r[0] for r in df.select(df[name].cast("double")).collect() if r[0] is not None)
        assert cut == [values[-(-len(values) * i // 16) - 1] for i in range(1, 16)]
