import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import spans
from strata.llm.gsaca import repeated_windows, suffix_array
from tests.llm.helpers import SF, documents, edge_docs, edge_rows, empty_docs, write_tables


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80))
def test_suffix_array_equals_sorting(symbols):
    text = [*symbols, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=25), min_size=1, max_size=4))
def test_repeated_windows_are_all_found(texts):
    raw = [t.encode() for t in texts]
    want = {}
    for k, t in enumerate(raw):
        for i in range(len(t) - 4):
            want.setdefault(t[i:i + 5], []).append((k, i))
    assert sorted(sorted(g) for g in repeated_windows(raw, 5)) == sorted(v for v in want.values() if len(v) > 1)


def brute(docs):
    """(bytes, removed, runs, digest) by a set of all windows seen so far."""
    seen, out = set(), []
    for _, text in docs:
        raw = (text or "").encode()
        gone, end = bytearray(len(raw)), 0
        for i in range(len(raw) - spans.WIDTH + 1):
            w = raw[i:i + spans.WIDTH]
            if w in seen:
                for j in range(max(i, end), i + spans.WIDTH):
                    gone[j] = 1
                end = i + spans.WIDTH
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return [tuple(r) for r in df.orderBy("doc_id").select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]


@pytest.mark.parametrize("group", [2048, 2])           # 2: nearly every anchor takes the path of hot ones
def test_query_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(spans, "GROUP", group)
    docs = documents(spark).orderBy("doc_id").collect()
    want = brute([(r["doc_id"], r["text"]) for r in docs])
    assert sum(w[1] for w in want) > 1000
    assert result(spans.op2_suffix_dedup(spark, SF)) == want


@pytest.mark.parametrize("group", [2048, 2])
def test_periods_overlaps_and_shifted_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(spans, "GROUP", group)
    a = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    texts = ["x" * 450, a, "ab" * 90 + a[50:260] + "q" * 99, a[10:130] + "-" + a[100:205] + "é" * 80, a[200:299], a[200:300],
             a + a, "x" * 100, "x" * 99, "é" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(spans.remove_repeats(df)) == brute(list(enumerate(texts)))


def test_edges(spark, tmp_path):
    rows = [r for r in edge_rows() if r[0] not in (None, 9, 10)]
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True))
    got = spans.op2_suffix_dedup(spark, folder)
    assert got.count() == 14
    assert result(got.filter("doc_id not in (9, 10)")) == brute([(r[0], r[1]) for r in rows])
    twice = spark.createDataFrame([(1, "k" * 40 + "".join(map(chr, range(48, 122))))] * 2, "doc_id long, text string")
    assert result(spans.remove_repeats(twice)) == brute([(1, twice.first()["text"])]) * 2
    assert spans.remove_repeats(empty_docs(spark)).collect() == []
