import random

import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from tests.llm.helpers import SF, edge_docs, empty_docs, write_tables

LABELS = "doc_id long, quality int, toxic int"


def test_folding_undoes_disguises():
    for plain, disguised in (("idiot", "1d10t"), ("scum", "ѕсum"), ("loser", "L0ser"), ("naive", "NAÏVE"), ("trash", "tr@sh"), ("idiot", "idi07"), ("moros", "moro$"), ("big", "b1g"), ("bigot", "81g0т"),
                             ("zeta", "2et@")):
        assert toxicity.fold_text(disguised) == f" {plain} " == toxicity.fold_text(plain)
    assert toxicity.fold_text("") == toxicity.fold_text(" 42!") == "  "


def test_heaviest_match_exceptions_and_length():
    lex = toxicity.Lexicon({" mor": 1.0, " moron ": 4.0}, {" morning "}, (-2.0, 2.0, 0.0))
    a = lex.automaton()
    assert list(lex.hits(a, " you moron ").values()) == [4.0]
    assert list(lex.hits(a, " good morning morons ").values()) == [1.0]
    short, long_ = lex.features(a, "moron"), lex.features(a, "moron " + "fine " * 500)
    assert short[0] == long_[0] and short[1] > long_[1]


def test_phrases_excuse_what_is_inside_them():
    lex = toxicity.Lexicon({" scum ": 2.0, " bag": 1.0, " trash ": 3.0}, {" pond scum ", " trash bag ", " bag of trash "})
    hits = lambda t: sorted(lex.hits(lex.automaton(), toxicity.fold_text(t)).values())               # noqa: E731
    assert hits("scum") == [2.0] and hits("pond scum") == [] and hits("pond, SCUM and scum") == [2.0]
    assert hits("a trash bag") == [] and hits("bags of trash") == [1.0, 3.0] and hits("bag of trash bag of scum") == [2.0]


def naive(lexicon, folded):
    """Every entry and every exception tried at every place."""
    at = lambda p: [i for i in range(len(folded)) if folded.startswith(p, i)]                       # noqa: E731
    inside = {s for p in lexicon.exceptions for i in at(p) for s in range(i + 1, i + len(p))}
    best = {}
    for entry, weight in lexicon.weights.items():
        if entry not in lexicon.exceptions:
            for i in at(entry):
                if i + 1 not in inside:
                    best[i + 1] = max(best.get(i + 1, 0.0), weight)
    return best


def test_automaton_equals_a_naive_scan():
    rng = random.Random(3)
    words = ["ab", "abc", "abca", "ba", "bab", "cab", "c"]
    for _ in range(300):
        weights = {rng.choice([f" {w} ", f" {w}"]): rng.randint(1, 5) * 1.0 for w in rng.sample(words, 4)}
        phrases = {" " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) + " " for _ in range(3)}
        lexicon = toxicity.Lexicon(weights, phrases)
        folded = toxicity.fold_text(" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))))
        assert lexicon.hits(lexicon.automaton(), folded) == naive(lexicon, folded)


def test_phrases_round_a_word():
    f = " a bb ccc "
    assert set(toxicity.phrases_at(f, 3)) == {" bb ", " a bb ", " bb ccc ", " a bb ccc "}
    assert set(toxicity.phrases_at(f, 1)) == {" a ", " a bb "} and set(toxicity.phrases_at(f, 6)) == {" ccc ", " bb ccc "}
    assert toxicity.phrases_at(" a ", 1) == [" a "]


def test_harmless_phrases_are_learned(spark):
    rows = [(f"tale {i} of the old pond scum by the lake", 0) for i in range(30)] + [(f"you scum number {i}x go away", 1) for i in range(30)]
    rows += [(f"quiet text {i}", 0) for i in range(300)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    hits = lambda t: lexicon.hits(lexicon.automaton(), toxicity.fold_text(t))                        # noqa: E731
    assert " pond scum " in lexicon.exceptions and " scum " not in lexicon.exceptions
    assert hits("the pond scum is green") == {} and hits("you scum") != {}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Two thousand texts; a tenth hold insults, some disguised, in two invented languages."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    docs, labels = [], []
    for i in range(2000):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(10, 120))]
        bad = i % 10 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobian", "gr0bian", "zwix" + rng.choice(vocabulary)]))
        docs.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    folder = tmp_path_factory.mktemp("toxic")
    return write_tables(spark, folder, documents=spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string, n_chars long"),
        labels=spark.createDataFrame(labels, LABELS))


def test_held_out_rows_are_told_apart(spark, planted):
    rows = toxicity.op8_toxicity_lexicon(spark, planted).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 300 and sum(r["predicted"] == (r["doc_id"] % 10 == 0) for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_never_read(spark, planted, tmp_path):
    labels = spark.read.parquet(f"{planted}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    a, b = (toxicity.trained(docs, x) for x in (labels, flipped))
    assert (a.weights, a.exceptions) == (b.weights, b.exceptions) and a.curve == pytest.approx(b.curve)


def test_edges(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 1), (8, 0, None), (None, 1, 1), (4, 1, 0), (99, 1, 1)], LABELS)
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True), labels=labels)
    rows = toxicity.op8_toxicity_lexicon(spark, folder).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}
    assert len(blank) == 1
    none = toxicity.trained(edge_docs(spark), spark.createDataFrame([], LABELS))
    scored = toxicity.score_toxicity(edge_docs(spark, extra=True), none)
    assert {r["score"] for r in scored.collect()} == {0.0} and "mine key" in {r["key"] for r in scored.collect()}
    assert toxicity.score_toxicity(empty_docs(spark), none).collect() == []


def test_query_runs_on_the_given_tables(spark):
    assert toxicity.op8_toxicity_lexicon(spark, SF).count() == 200
