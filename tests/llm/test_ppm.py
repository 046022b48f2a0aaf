import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import ppm
from tests.llm.helpers import SF, ascii_lower, documents, edge_docs, edge_rows, words, write_tables


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10


class Brute:
    """Contexts as dictionaries, symbols predicted one by one."""

    def __init__(self, texts):
        self.after = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            b = self.stream(t)
            for i in range(ppm.ORDER, len(b)):
                for k in range(ppm.ORDER + 1):
                    self.after[k][tuple(b[i - k:i])][b[i]] += 1

    @staticmethod
    def stream(t):
        return [ppm.END] * ppm.ORDER + list((t or "").encode()) + [ppm.END]

    def log10(self, t):
        total, b = 0.0, self.stream(t)
        for i in range(ppm.ORDER, len(b)):
            gone = set()
            for k in range(ppm.ORDER, -1, -1):
                seen = self.after[k].get(tuple(b[i - k:i]))
                if not seen:
                    continue
                left = {s: n for s, n in seen.items() if s not in gone}
                scale = sum(left.values()) + len(left)
                if b[i] in left:
                    total += math.log10(left[b[i]] / scale)
                    break
                if left:
                    total += math.log10(len(left) / scale)
                gone |= set(seen)
            else:
                total -= math.log10(ppm.SYMBOLS - len(gone))
        return total


def check(rows, docs):
    train = [(k, t) for k, t in docs if fold(k)]
    counts = Counter()
    for _, t in train:
        counts.update([*words(ascii_lower(t)), None])
    total, distinct, model = sum(counts.values()), len(counts), Brute([t for _, t in train])
    scores = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"],
                     round(r["base_score"], 6), round(r["score"], 6)) for r in rows)
    want = []
    for k, t in docs:
        w = [*words(ascii_lower(t)), None]
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        want.append((k is None, k or 0, len(w), sum(counts[x] > 0 for x in w), total, fold(k) == 0, round(base, 6),
                     round(model.log10(t), 6)))
    for a, b in zip(scores, sorted(want), strict=True):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], rel=1e-9, abs=2e-6)


def test_query_equals_brute_force(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    check(ppm.op9_ppm_score(spark, SF).collect(), docs)
    monkeypatch.setattr(ppm, "FREQUENT", 50)                   # most words by the join
    check(ppm.op9_ppm_score(spark, SF).collect(), docs)


def test_edges(spark, tmp_path):
    rows = [r for r in edge_rows() if r[0] != 7] + [(7, "a " * 3000, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = write_tables(spark, tmp_path, documents=df)
    check(ppm.op9_ppm_score(spark, folder).collect(), [(r[0], r[1]) for r in rows])


def test_empty_table_and_no_training_rows(spark, tmp_path):
    key = next(i for i in range(100) if fold(i) == 0)
    held = edge_docs(spark).limit(0).unionByName(
        spark.createDataFrame([(key, "ab", None, None, 1)], edge_docs(spark).schema))
    folder = write_tables(spark, tmp_path / "one", documents=held)
    row = ppm.op9_ppm_score(spark, folder).first()
    assert row["score"] == pytest.approx(-3 * math.log10(256)) and (row["n_known"], row["train_tokens"]) == (0, 0)
    folder = write_tables(spark, tmp_path / "none", documents=held.limit(0))
    assert ppm.op9_ppm_score(spark, folder).collect() == []


def test_probabilities_sum_to_one():
    texts = ["abracadabra", "abc", "cab ab", "ü"]
    code, _ = ppm.grams(*_join(texts))
    trie = ppm.Trie(*np.unique(code, return_counts=True))
    for context in (b"\xff\xff\xff\xff", b"\xffabr", b"zzzz", b"\xff\xffab", b"cab "):
        head = int.from_bytes(context, "big") << 8
        p = 10 ** trie.log10(np.arange(head, head + 256, dtype=np.uint64))
        assert p.sum() == pytest.approx(1.0)


def _join(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def test_equal_texts_get_equal_bits(spark, tmp_path):
    """Scores do not depend on what stands before a text in its batch."""
    texts = [r["text"] for r in documents(spark).limit(12).collect()]
    rows = [(k, texts[k * 7 % 12], "en", "s", 1) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = write_tables(spark, tmp_path, documents=df.repartition(3))
    got = {}
    for r in ppm.op9_ppm_score(spark, folder).collect():
        got.setdefault(texts[r["doc_id"] * 7 % 12], set()).add((r["base_score"], r["score"]))
    assert len(got) == 12 and all(len(v) == 1 for v in got.values())


def test_least_count(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([5, 5, 3, 1, 1, 1])], "code long, n long")
    assert [ppm.least_count(counts, m) for m in (6, 5, 3, 2, 1)] == [1, 2, 2, 4, 6]


def test_rare_contexts_are_scored_whole(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    monkeypatch.setattr(ppm, "MAX_ENTRIES", 500)               # most codes by the join
    monkeypatch.setattr(ppm, "CHUNK", 1000, raising=False)
    check(ppm.op9_ppm_score(spark, SF).collect(), docs)
