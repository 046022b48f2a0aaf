import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import passages
from strata.llm.arrowtext import Powers, byte_values, word_hashes
from tests.llm.helpers import SF, documents, edge_docs, empty_docs, words, write_tables


def brute(rows):
    """(key, words, removed, digest) by a table of every window's smallest key."""
    big = (1 << 63) - 1
    split = [(k, words(t)) for k, t in rows]
    first = {}
    for k, w in split:
        for i in range(len(w) - 12):
            x = tuple(w[i:i + 13])
            first[x] = min(first.get(x, big), big if k is None else k)
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < (big if k is None else k):
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in df.collect()), key=repr)


def prose(seed, n, size=40):
    draw = np.random.default_rng(seed)
    return [f"w{i}" for i in draw.integers(0, size, n)]


def test_query_equals_brute_force(spark):
    want = brute([(r["doc_id"], r["text"]) for r in documents(spark).collect()])
    assert sum(w[2] for w in want) > 1000
    assert result(passages.op11_phrase_automata(spark, SF)) == want


@pytest.mark.parametrize("shard, rows", [(1 << 17, 1 << 19), (40, 0)])   # many shards, split owners, no broadcast
def test_chains_and_hot_passages(spark, monkeypatch, shard, rows):
    monkeypatch.setattr(passages, "SHARD_WORDS", shard)
    monkeypatch.setattr(passages, "BROADCAST_ROWS", rows)
    common, other = prose(1, 30), prose(2, 60)
    docs = []
    for k in range(60):
        own = prose(100 + k, 20, 10_000)
        docs.append((k * 7 % 61, " ".join(own[:9] + (common[k % 5:] if k % 3 else other[:13 + k % 30]) + own[9:])))
    docs += [(200, " ".join(common * 3)), (201, "a " * 80), (202, "a\tb " * 3 + "a " * 40), (203, "\n".join(other)), (204, " ".join(other[5:17])),
             (205, " ".join(other[5:18])), (None, " ".join(other)), (None, " ".join(prose(9, 40))), (-4, " ".join(other[20:50]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(passages.remove_passages(df)) == brute(docs)


def test_rows_of_one_key(spark):
    a, b = " ".join(prose(3, 40)), " ".join(prose(4, 40))
    rows = [(5, a), (5, a), (5, a + " x " + b), (6, b), (6, b + " y"), (None, a), (None, a), (None, b + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(passages.remove_passages(df)) == brute(rows)


def test_windows_are_compared_one_by_one_only_where_texts_part(spark, monkeypatch):
    """Copies and copies with a changed word: the groups that all documents share have their owner
    from the minimiser."""
    made, keep = [], passages.materialize
    monkeypatch.setattr(passages, "materialize", lambda df: made.append(keep(df)) or made[-1])
    texts = [prose(300 + k, 200, 5_000) for k in range(12)]
    rows = [(k + 100 * c, " ".join(t[:90] + [f"new{k}-{c}"] + t[91:] if c == 3 and k % 2 else t)) for k, t in enumerate(texts) for c in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(passages.remove_passages(df)) == brute(rows)
    owned = [m for m in made if m.columns == ["hash", "owner"]][-1]
    assert 0 < owned.count() < 6 * 60 < 12 * 188                # of 188 windows a text


def test_one_hash_for_all_windows(spark, monkeypatch):
    """Where hashes do not tell windows apart, the words still do."""
    monkeypatch.setattr(passages, "_chained", lambda h, k: np.full(len(h) - k + 1, 7, np.uint64))
    a, b = prose(5, 40), prose(6, 50)
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(b[3:30] + a[:20])), (4, " ".join(prose(7, 30)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(passages.remove_passages(df)) == brute(rows)


def test_texts_are_returned(spark):
    a = prose(8, 20)
    df = spark.createDataFrame([(1, " ".join(a)), (2, "mine  " + " ".join(a[2:]) + "\tend")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in passages.remove_passages(df).collect()} == {1: " ".join(a).encode(), 2: b"mine end"}


def test_edges(spark, tmp_path):
    docs = edge_docs(spark, extra=True)
    folder = write_tables(spark, tmp_path, documents=docs)
    assert result(passages.op11_phrase_automata(spark, folder)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert passages.remove_passages(empty_docs(spark)).collect() == []


def test_long_words_do_not_collide():
    """Two words whose polynomials modulo 2^64 agree for every base."""
    thue = [bin(i).count("1") % 2 for i in range(1024)]
    texts = ["".join("ab"[b] for b in thue), "".join("ba"[b] for b in thue)]
    raw = np.frombuffer(" ".join(texts).encode(), np.uint8)
    hashes, first = word_hashes(raw, np.array([0, len(raw)]), byte_values(), Powers())
    assert len(set(hashes.tolist())) == 2 and first.tolist() == [0, 2]
