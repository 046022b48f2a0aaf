"""Toxicity by a weighted lexicon.

Texts are folded first: case, accents, look-alike letters of other scripts, and digits and
signs standing for letters beside a letter all become plain letters, so disguised spellings
meet the lexicon wherever in a word the disguise is.
The lexicon holds whole words and word beginnings with weights, and exception phrases of
one to three words, all in one Aho-Corasick automaton over the folded text. A word counts
its heaviest match; a match inside an exception phrase counts nothing. The sum of weights,
normalised by length, gives the score through a logistic curve.

Weights, exceptions and curve are learned from labelled rows, at most ``SAMPLE_ROWS`` of
them (an even sample by hash of the key), which bounds everything the learning collects: an
entry is in at least ``MIN_SHARE`` of the sample's toxic texts, an exception in ``MIN_ROWS``.
Every text is scored whole.

Defined results: null and empty texts score as texts without a match; rows without a
label are only scored; a key with several labels is toxic if one says so; equal texts
get equal scores; without any labelled rows every text scores 0; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from typing import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm.common import read
from strata.session import materialize

FOLDS = 5
SAMPLE_ROWS = 40_000          # labelled rows that are learned from, at most (about)
MIN_ROWS = 4                  # toxic texts that a lexicon entry occurs in, at least,
MIN_SHARE = 1 / 300           # and at least this share of them
MIN_RATIO = 6.0               # times as frequent among toxic rows as among others
PHRASE_RATIO = 6.0            # times as frequent among clean rows as among toxic ones, for a phrase of words
SPREAD = 64                   # parts of the sample
STEMS = (4, 5, 6)             # lengths of word beginnings that may become entries
LENGTH_NORM = 20.0            # words added to a text's length before normalising

# Letters of other scripts that look like Latin ones, and digits read as letters.
LOOKALIKES = dict(zip("аеорсхуіјѕһԁԛԝкмтвнαεορτυικνχ", "aeopcxyijshdqwkmtbhaeoptuiknx"))
DIGITS = dict(zip("0123456789", "oizeasgtbg"))
_DIGIT_IN_WORD = re.compile(r"[0-9@$]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$]+")      # beside a letter
_TABLE = str.maketrans(LOOKALIKES)
_DIGIT_TABLE = str.maketrans(DIGITS | {"@": "a", "$": "s"})
_BREAK = re.compile(r"[\W\d_]+")


def fold_text(text: str) -> str:
    """Folded letters only, words separated by single spaces, a space at both ends."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(ch for ch in text if not unicodedata.combining(ch)).translate(_TABLE)
    text = _DIGIT_IN_WORD.sub(lambda m: m.group().translate(_DIGIT_TABLE), text)
    return " " + _BREAK.sub(" ", text).strip() + " "


def entries(folded: str) -> set[str]:
    """Candidate lexicon entries of a text: " word " for whole words, " stem" for beginnings."""
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
            out.update(" " + w[:k] for k in STEMS if len(w) > k)
    return out


def phrases_at(folded: str, start: int) -> list[str]:
    """Phrases of one to three words with the word that starts there and its neighbours."""
    before = folded.rfind(" ", 0, start - 1) if start > 1 else 0
    end = folded.index(" ", start)
    after = folded.find(" ", end + 1)
    out = [folded[start - 1:end + 1]]
    if start > 1:
        out.append(folded[before:end + 1])
    if after > 0:
        out.append(folded[start - 1:after + 1])
        if start > 1:
            out.append(folded[before:after + 1])
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)     # folded phrases, " word word "
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            a.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:                    # instead of an entry of the same spelling
            a.add_word(phrase, (len(phrase), None))
        if self.weights:
            a.make_automaton()
        return a

    def hits(self, automaton: ahocorasick.Automaton, folded: str) -> dict[int, float]:
        """Heaviest weight by start of the matched word, of words outside all exceptions."""
        best: dict[int, float] = {}
        if not self.weights:
            return best
        excused = []
        for end, (length, weight) in automaton.iter(folded):
            start = end - length + 2
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if excused and best:
            excused.sort()
            at = reach = 0
            for start in sorted(best):
                while at < len(excused) and excused[at][0] <= start:
                    reach, at = max(reach, excused[at][1]), at + 1
                if start < reach:
                    del best[start]
        return best

    def features(self, automaton: ahocorasick.Automaton, text: str) -> tuple[float, float]:
        """Weight of all matches, and the same normalised by length, both damped."""
        folded = fold_text(text)
        weight = sum(self.hits(automaton, folded).values())
        words = folded.count(" ") - 1
        return float(np.log1p(weight)), float(np.log1p(100.0 * weight / (words + LENGTH_NORM)))


def logistic(curve: tuple[float, float, float], x: np.ndarray) -> np.ndarray:
    z = curve[0] + x @ np.asarray(curve[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -60, 60)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)),
                               a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fold(key: str | Column) -> Column:
    """CRC32 of the key as text, modulo ``FOLDS``; fold 0 is held out."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """Distinct ``text`` and ``label`` of about ``rows`` labelled rows outside the
    held-out fold. Distinct, so that the words of one text copied often are no evidence."""
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(key) != 0))
             .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("label")))
    total = known.count()
    if total > rows:
        share = F.pmod(F.xxhash64(key), F.lit(1 << 20))
        known = known.filter(share < F.lit(int((1 << 20) * rows / total)))
    # At most about ``rows`` keys and labels, 16 bytes each: small by construction.
    return docs.select(key, F.col("text")).join(F.broadcast(known), key).select("text", "label").distinct()


def _entry_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[str, list[int]] = {}
        for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            for e in entries(fold_text(text or "")):
                counts.setdefault(e, [0, 0])[1 if label else 0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts)), *[pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1)]],
            ["entry", "clean", "toxic"])


def learn(sample: DataFrame) -> Lexicon:
    """Lexicon, exceptions and curve from ``text`` and ``label`` (0 or 1) of a bounded frame."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Lexicon({})
    least = max(MIN_ROWS, int(n_toxic * MIN_SHARE))
    counts = (sample.mapInArrow(_entry_counts, "entry string, clean long, toxic long")
              .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    strong = (counts.filter(F.col("toxic") >= least).withColumn("ratio", ratio)
              .filter(F.col("ratio") >= MIN_RATIO).collect())
    weights = {r["entry"]: float(np.log(r["ratio"])) for r in strong}
    lexicon = Lexicon(weights)

    def matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            found: dict[str, list[int]] = {}
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                folded = fold_text(text or "")
                for phrase in {p for i in lexicon.hits(automaton, folded) for p in phrases_at(folded, i)}:
                    found.setdefault(phrase, [0, 0])[1 if label else 0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *[pa.array([c[k] for c in found.values()], pa.int64()) for k in (0, 1)]],
                ["phrase", "clean", "toxic"])

    # Words that a stem matches but that are no more frequent among toxic rows, and phrases
    # round a matched word that belong to clean rows.
    times = F.when(F.size(F.split(F.trim("phrase"), " ")) > 1, PHRASE_RATIO).otherwise(1.0)
    innocent = (sample.mapInArrow(matched, "phrase string, clean long, toxic long").groupBy("phrase")
                .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                .filter((F.col("clean") >= MIN_ROWS)
                        & (F.col("clean") * F.lit(n_toxic) >= times * F.col("toxic") * F.lit(n_clean))).collect())
    lexicon.exceptions = {r["phrase"] for r in innocent}

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            x = [lexicon.features(automaton, t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()), b.column("label")],
                ["a", "b", "label"])

    points = sample.mapInArrow(features, "a double, b double, label int").toPandas()
    lexicon.curve = fit_curve(points[["a", "b"]].to_numpy(), points["label"].to_numpy(float))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score column added (replacing one of that name)."""
    kept = docs.drop(name)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            x = [lexicon.features(automaton, t.as_py() or "") for t in b.column(text)]
            scores = logistic(lexicon.curve, np.array(x).reshape(-1, 2)) if lexicon.weights else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, name])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(name, DoubleType())]))


# --- registered query -------------------------------------------------------------------


def trained(docs: DataFrame, labels: DataFrame) -> Lexicon:
    return learn(materialize(labelled_sample(docs, labels).repartition(SPREAD)))


def op8_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = trained(docs, read(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, lexicon)
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity_lexicon": op8_toxicity_lexicon}
ORACLE: dict[str, str] = {}
