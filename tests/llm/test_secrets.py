import hashlib
import re

from strata.llm import secrets
from tests.llm.helpers import documents, edge_docs, empty_docs, write_tables

RAW = [re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
       re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]


def base(text):
    """The definition itself: leftmost matches per kind, those that fail dropped."""
    out = []
    for rank, (pattern, least) in enumerate(zip(RAW, (6, 20, 24))):
        out += [(m.start(), rank, m.end()) for m in pattern.finditer(text or "") if len(m[2] if rank == 0 else m[0]) >= least]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{secrets.KINDS[r]}:{i}:{j}" for i, r, j in spans).encode()).hexdigest()


def test_query_keeps_the_base_spans(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    hits = 0
    for r in secrets.op5_secret_ownership(spark, sf).collect():
        spans = base(texts[r["doc_id"]])
        hits += len(spans)
        assert r["base_sha256"] == digest(spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert {f"{secrets.KINDS[k]}:{i}:{j}" for i, k, j in spans} <= set(r["spans"].split(","))
    assert hits


def test_definition_on_awkward_strings():
    for text in ("AKIAAKIA" + "A" * 15, "AKIA" + "B" * 16, "a" * 23, "f" * 24 + "g" + "0" * 30, "TOKEN='abcdef' token=abc",
                 "ſecret: abcdefgh", "api_key  =  \"x.y/z+1=-\"", "passwordpassword=123456", "secret:token=abcdef12"):
        assert [(i, r, j) for i, r, j, *_ in secrets.find(text) if r < 3] == base(text), text


def test_ownership_separates_examples_from_live_values(spark, tmp_path):
    example, own = "a1b2c3d4e5f6a7b8c9d0e1f2a3b4", "9f8e7d6c5b4a39281706f5e4d3c2"
    rows = [(i, f"token = {example}", "en", f"owner{i}", 1) for i in range(5)]
    rows += [(10, f"token = {own} and again {own}", "en", "owner1", 1), (11, f"see {own}", "de", "owner1", 1)]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"))
    got = {r["doc_id"]: r for r in secrets.op5_secret_ownership(spark, folder).collect()}
    assert all(got[i]["n_live"] == 0 and got[i]["n_examples"] == 1 for i in range(5))
    assert got[10]["n_live"] == 2 and "live:8:36" in got[10]["spans"].split(",") and got[11]["n_live"] == 1


def test_edges(spark, tmp_path):
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True))
    rows = secrets.op5_secret_ownership(spark, folder).collect()
    assert len(rows) == 14 and all(r["base_sha256"] == digest([]) and r["spans"] == "" for r in rows)
    assert secrets.scan_secrets(empty_docs(spark), repository="lang").collect() == []


def test_owners_and_repositories_are_given_per_value(spark, tmp_path):
    value = "9f8e7d6c5b4a39281706f5e4d3c2"
    rows = [(i, f"token = {value}", f"l{i % 6}", f"owner{i % 2}", 1) for i in range(12)]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"))
    for r in secrets.op5_secret_ownership(spark, folder).collect():
        assert (r["n_live"], r["n_examples"], r["ownership"]) == (1, 0, "8:36:2:6")
