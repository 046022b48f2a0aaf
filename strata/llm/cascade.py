"""Quality rules as a short-circuit cascade.

Each rule is a native boolean expression that rejects a row, measures of the text
included. On a sample of texts, every rule is timed and its share of rejections counted;
the rules are then tried in the order of rejections per unit of cost, and a row stops at
the first rule that rejects it (a ``CASE WHEN`` chain, which evaluates a branch only for
rows that reach it, after the rows already given up). The order changes only the cost: a
row is kept if no rule rejects it. Measures that are results themselves are taken of every
row; the rules that only compare them cost next to nothing and mostly come first.

Defined results: a null text has no words and counts as empty; a rule that gives null
does not reject; equal rows get equal verdicts; an empty table gives an empty result;
columns named like the outputs are replaced.
"""

from __future__ import annotations

import math
import statistics
import time
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ASCII_UPPER, SPACE_CLASS, read, text_or_empty, words
from strata.session import materialize

SAMPLE_ROWS = 2_000       # rows on which cost and selectivity are estimated
RUNS, REPEATS = 3, 16     # timings of a rule (their median counts), and of a row in each
WINDOW = 8                # words of a repeated window


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejected: float       # share of sampled rows
    cost: int             # microseconds a row above reading it, rounded up to a power of two

    @property
    def gain(self) -> float:
        return self.rejected / self.cost


def sample_of(df: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """About ``rows`` rows, evenly from the whole frame (all rows of a small one)."""
    total = df.count()
    return df if total <= rows else df.sample(rows / total, seed)


def estimate(sample: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """Cost and selectivity of each rule, most rejections per cost first.

    Every row is judged ``REPEATS`` times in a timing, so that a rule outweighs the job around
    it; costs are classes of factor two, so that noise seldom changes the order.
    """
    sample = materialize(sample)
    rows = max(1, sample.count())
    again = sample.select("*", F.explode(F.array_repeat(F.lit(0), REPEATS)).alias("_again"))

    def run(c: Column) -> tuple[float, float]:
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            row = again.agg(F.avg(c.cast("int")).alias("share")).first()
            times.append(time.perf_counter() - began)
        return row["share"] or 0.0, statistics.median(times)

    plain = F.octet_length(F.col(sample.columns[-1]).cast("string")) > 1 << 30     # reads the column that rules read
    run(plain)                                                    # warm up
    base = run(plain)[1]
    found = []
    for r in rules:
        share, seconds = run(F.coalesce(r.rejects, F.lit(False)))
        micros = max(1.0, (seconds - base) * 1e6 / (rows * REPEATS))
        found.append(Estimate(r, share, 1 << math.ceil(math.log2(micros))))
    return sorted(found, key=lambda e: (-e.gain, e.rule.name))


def cascade(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rule", given_up: Column | None = None) -> DataFrame:
    """Add the name of the first rule, in the given order, that rejects the row. Rows already
    ``given_up`` reach no rule and get null."""
    none = F.lit(None).cast("string")
    verdict = F.when(F.lit(False) if given_up is None else given_up, none)
    for r in rules:
        verdict = verdict.when(F.coalesce(r.rejects, F.lit(False)), F.lit(r.name))
    return df.withColumn(name, verdict.otherwise(none))


# --- text measures ----------------------------------------------------------------------


def window_hash(hashes: Column, at: Column, n: int) -> Column:
    """Hash of ``n`` consecutive word hashes."""
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(n)])


def _covered(pairs: str, n: int) -> Column:
    """Words inside windows that occur at least twice, from the column of sorted
    (window hash, start) pairs. A column, not an expression: the lambda looks at both
    neighbours, and an expression would be computed again for every element."""
    p = F.col(pairs)
    twins = F.filter(p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]))
    starts = F.sort_array(F.transform(twins, lambda x: x["i"]))
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + n).alias("end"),
                                (acc["n"] + i + n - F.greatest(i, acc["end"])).alias("n")),
        lambda acc: acc["n"])


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures of every whole text.

    n_words, word_chars (code points in words), n_symbols, n_lines (with a word),
    n_dup_lines (equal to an earlier line), n_repeat_words (words in 8-word windows
    found twice or more, the first included) and base_failed.
    """
    t = text_or_empty(text)
    out = df.withColumns({"_words": words(text),
                          "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(SPACE_CLASS.replace("[", "[^")))})
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_lines", "_words")
    out = out.withColumn("_win", F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
                    lambda i: window_hash(F.col("_hashes"), i, WINDOW)))).drop("_hashes")
    out = out.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_win")
    out = out.withColumn("n_repeat_words", F.when(
        F.col("_pairs").isNotNull(), _covered("_pairs", WINDOW)).otherwise(0).cast("long")).drop("_pairs")
    return out.withColumn("base_failed", (F.col("n_words") < 20)
                          | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules over the measures and the text; thresholds leave ordinary prose alone. Capitals
    and distinct words are counted inside their rules, for rows that reach them."""
    capitals = F.regexp_count(text_or_empty(text), F.lit("[A-Z]"))
    distinct = F.size(F.array_distinct(words(text)))
    return [
        Rule("symbols", 20 * F.col("n_symbols") > F.col("word_chars")),
        Rule("dup_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("shouting", 10 * capitals > 4 * F.col("word_chars")),
        Rule("word_length", (F.col("word_chars") > 14 * F.col("n_words"))
             | (F.col("word_chars") < 2 * F.col("n_words"))),
        Rule("variety", 20 * distinct < F.col("n_words")),
    ]


# --- registered query -------------------------------------------------------------------


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(measure(sample_of(docs))).filter(~F.col("base_failed"))        # the rows that rules see
    order = estimate(measured.select(*[c for c in measured.columns if c != "text"], "text"), default_rules())
    judged = cascade(measure(docs), [e.rule for e in order], given_up=F.col("base_failed"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"))


_WORD = r"[^\x20\x09-\x0D]"

OP3_SQL = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l
  from documents),
win as (
  select r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as s
  from (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d)),
hit as (
  select r, i from (select r, i, count(*) over (partition by r, s) as n from win) where n > 1),
rep as (
  select r, count(distinct p) as n from (select r, unnest(range(i, i + {WINDOW})) as p from hit)
  group by r),
m as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
         len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
         len(list_distinct(w)) as n_distinct, coalesce(rep.n, 0) as n_repeat_words,
         length(t) - length(translate(t, '{ASCII_UPPER}', '')) as capitals
  from d left join rep using (r)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
       n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and not (20 * n_symbols > word_chars or 2 * n_dup_lines > n_lines
         or 10 * capitals > 4 * word_chars or word_chars > 14 * n_words
         or word_chars < 2 * n_words or 20 * n_distinct < n_words) as kept
from b
"""

QUERIES = {"op3_quality_cascade": op3_quality_cascade}
ORACLE = {"op3_quality_cascade": OP3_SQL}
