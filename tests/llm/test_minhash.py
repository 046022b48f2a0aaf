import numpy as np
import pytest

from pyspark.sql import functions as F

from strata.llm import components, minhash
from tests.llm.helpers import PROSE, SF, ascii_lower, documents, edge_docs, empty_docs, words


def shingles(text, k):
    w = words(ascii_lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, similarity=80):
    """Smallest reachable key by comparing all pairs."""
    sets, root = {}, {}
    for key, text in rows:
        if key is not None:
            sets.setdefault(key, []).append(shingles(text, k))
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= similarity * len(x | y):
                        root[max(find(a), find(b))] = min(find(a), find(b))
    return {key: find(key) for key in keys}


@pytest.mark.parametrize("k", [2, 5])
def test_groups_equal_brute_force(spark, k):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    want = brute(rows, k)
    got = minhash.near_duplicates(documents(spark), k=k).collect()
    assert {r["key"]: r["root"] for r in got} == want
    assert {r["key"]: r["n"] for r in got} == {key: len(shingles(t, k)) for key, t in rows}
    assert any(key != root for key, root in want.items())


def test_query_columns(spark):
    for r in minhash.op7_circulant_minhash(spark, SF).collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_chains_and_outsiders_are_not_lost(spark):
    """Neighbours in the chain are near, its ends are far apart: one component all the same."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*(f"v{j}" for j in range(2 * i)), *base[2 * i:]])) for i in range(12)]
    rows += [(100 + i, " ".join(f"u{i}x{j}" for j in range(60))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["key"]: r["root"] for r in minhash.near_duplicates(df, k=2).collect()}
    assert got == brute(rows, 2) and len({got[i] for i in range(12)}) == 1


def test_edges(spark):
    docs = edge_docs(spark, extra=True)
    got = [(r["key"], r["n"], r["root"]) for r in minhash.near_duplicates(docs, k=2).collect()]
    assert len(got) == 14 and sorted(r for r in got if r[0] in (1, 2, 3)) == [(1, 33, 1), (2, 33, 1), (3, 34, 1)]
    assert {r for r in got if r[0] in (4, 5, 6)} == {(4, 0, 4), (5, 0, 5), (6, 0, 6)}
    assert [r[2] for r in got if r[0] is None] == [None, None]
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or 0) for r in kept.collect())
    assert ids == [0, 0, 1, 4, 5, 6, 7, 8, 9, 10, 10]      # the repeated row of 9 once, both texts of 10
    assert minhash.near_duplicates(empty_docs(spark)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = np.concatenate([common, a, common, b])
    s = minhash.signatures(sets, np.array([0, 900, 1800]), 2000)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.05


def test_components_of_long_paths(spark):
    edges = spark.range(306).selectExpr("id * 7 % 307 as u", "(id + 1) * 7 % 307 as v")
    got = components.components(edges).collect()
    assert len(got) == 307 and {r["root"] for r in got} == {0}
    assert components.components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []


def test_short_texts_are_one_shingle(spark):
    df = spark.createDataFrame([(1, "One"), (2, "one"), (3, PROSE[:5])], "doc_id long, text string")
    assert {r["key"]: r["root"] for r in minhash.near_duplicates(df, k=5).collect()} == {1: 1, 2: 1, 3: 3}


def test_every_text_of_a_repeated_key_is_compared(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    df = spark.createDataFrame([(10, a), (10, b), (20, a + " x"), (30, b + " y"), (40, "c " + b), (50, "d e f g h"), (20, None)],
                               "doc_id long, text string")
    for rows in (df, df.orderBy(F.desc("text"))):
        got = minhash.near_duplicates(rows).collect()
        assert {(r["key"], r["root"]) for r in got} == {(10, 10), (20, 10), (30, 10), (40, 10), (50, 50)} and len(got) == 7


@pytest.mark.parametrize("k", [2, 5])
def test_a_hot_group_around_the_similarity(spark, k):
    """300 copies of one text with as many words changed, lost or added as leave some pairs
    just above the similarity and others just below."""
    draw = np.random.default_rng(11)
    base = [f"w{i}" for i in draw.integers(0, 400, 150)]
    rows = []
    for key in range(300):
        text = list(base)
        for at in draw.choice(150, draw.integers(3, 14) if k == 2 else draw.integers(1, 6), replace=False):
            text[at] = ["", f"x{draw.integers(0, 50)}", f"{text[at]} y{draw.integers(0, 50)}"][draw.integers(0, 3)]
        rows.append((key * 13 % 307, " ".join(text)))
    want = brute(rows, k)
    assert 1 < len(set(want.values())) < 250
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["key"]: r["root"] for r in minhash.near_duplicates(df, k=k).collect()} == want
