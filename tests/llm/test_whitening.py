import math

import numpy as np
import pytest

from strata.llm import whitening
from tests.llm.helpers import SF, write_tables

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """(n, {vec_id: (deviation, whitened)}, explained) with plain numpy over the distinct vectors."""
    x = {k: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for k, v in rows
         if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(x.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array(fit, float) - np.array(s, float) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {k: (sum((n * c - t) ** 2 for c, t in zip(v, s)), (np.array(v) - np.array(s, float) / n) @ vectors / np.sqrt(values))
           for k, v in x.items()}
    return n, out, values / np.trace(a.T @ a / n)


def check(got, want):
    n, rows, explained = want
    by_key = {}
    for r in got:
        by_key.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by_key) == set(rows)
    width = len(explained)
    signs = None
    for k, (deviation, w) in rows.items():
        own = [by_key[k][c + 1] for c in range(width)]
        assert {(r["n"], r["deviation"]) for r in own} == {(n, deviation)}
        got_w = np.array([r["whitened"] for r in own])
        if signs is None:
            signs = np.sign(got_w) * np.sign(w)
        assert np.allclose(got_w, signs * w, atol=1e-7)
        assert np.allclose([r["explained"] for r in own], explained, rtol=1e-9)
        assert own[0]["identity_error"] < 1e-6


def test_query_equals_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(whitening.op13_embedding_whitening(spark, SF).collect(), brute(rows))


def test_copies_nulls_and_bad_entries(spark, tmp_path):
    draw = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in draw.normal(0, 3, 5)], 1) for i in range(40)]
    rows += [(100 + i, rows[3][1], None) for i in range(60)]           # a hot vector
    rows += [(200, None, 1), (201, [1.0, None, 2.0, 0.0, 0.0], 1), (202, [float("nan")] * 5, 1), (203, [float("inf")] + [0.0] * 4, 1)]
    folder = write_tables(spark, tmp_path, embeddings=spark.createDataFrame(rows, SCHEMA).repartition(7))
    got = whitening.op13_embedding_whitening(spark, folder).collect()
    check(got, brute([(k, v) for k, v, _ in rows]))
    assert len(got) == 100 * 5


def test_fit_by_counts(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.5]), (4, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one, count = (whitening.whitened_rows(df, weights=w).first() for w in ("one", "count"))
    assert (one["n"], count["n"]) == (3, 4)
    x = np.array([[64 * c for c in v] for _, v in rows])
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose(count["explained"], values / values.sum()) and count["identity_error"] < 1e-9


def test_flat_ragged_and_huge_vectors(spark):
    make = lambda *v: spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    flat = whitening.whitened_rows(make([1.0, 2.0], [1.0, 2.0])).collect()
    assert [(r["n"], r["copies"], r["deviation"], r["whitened"], r["identity_error"]) for r in flat] == [(1, 2, 0, [None, None], None)] * 2
    line = whitening.whitened_rows(make([0.0], [1.0], [], [0.0, 0.0])).orderBy("vec_id").collect()
    assert [r["x"] for r in line] == [[1000000, 1000000], [1000064, 1000000], [1000000, 1000000], [1000000, 1000000]]
    assert {r["n"] for r in line} == {2} and line[0]["whitened"] == [pytest.approx(-1.0), None]
    huge = whitening.whitened_rows(make([1e300, 0.0], [-1e300, 1.0], [0.0, 0.0])).collect()
    assert all(r["deviation"] is None for r in huge if r["vec_id"] < 2) and len(huge) == 3


def test_extra_columns_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, [1.0, 0.0], 1, 9), (1, [0.0, 1.0], 2, 9), (None, [1.0, 1.0], 3, 9), (4, [0.0, 0.0], 3, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, x long")
    got = whitening.op13_embedding_whitening(spark, write_tables(spark, tmp_path, embeddings=df)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.op13_embedding_whitening(spark, write_tables(spark, tmp_path / "none", embeddings=empty)).collect() == []
