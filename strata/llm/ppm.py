"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` deep, learned from all training
texts: how often each byte followed each context. A byte is predicted in its longest
context that was seen; a byte that context never saw costs an escape (method C: an
escape weighs as much as the context has distinct successors) and is then predicted in
the next shorter context, without the symbols the longer one has already excluded. Below
the empty context all symbols left are equally likely. A text ends with a symbol of its
own (byte 255, which UTF-8 never uses), so code lengths are proper probabilities.

Counting is one aggregate of (context, byte) counts, pre-added in every batch; no context
is left out. The counts stay a table. It is dealt out by the last ``DEALT`` bytes of the
context, so a task has all longer contexts of its entries and what follows them (65,536
entries at a time at most); of the shorter contexts there are 2 ** 24 pairs at most, which
are sent to all tasks. So every (context, byte) that any text has gets its exact log
probability. The ``MAX_ENTRIES`` most frequent are sent to the scoring tasks as sorted
arrays, all others are joined by their code.

The unigram word score beside it needs exact counts of every word: words above a
frequency that at most ``FREQUENT`` words can have are sent to the tasks, all others are
joined by their hash.

Defined results: a null text counts as empty and has only its end; equal rows get equal
scores; a table without training rows gives the uniform model; an empty table gives an
empty result.
"""

from __future__ import annotations

from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.arrowtext import (
    Powers, as_bytes, byte_values, lower, pieces, word_hashes,
)
from strata.llm.common import read
from strata.session import materialize

ORDER = 4
WHOLE = 2                     # contexts of so many bytes go to every task: 2 ** 24 pairs at most
DEALT = WHOLE + 1             # last bytes of the context that deal entries out
END = 255                     # the symbol after the last byte of a text
SYMBOLS = 256
MAX_ENTRIES = 4_000_000       # (context, byte) entries sent to tasks
CHUNK = 1 << 20               # entries that get their probability at once
RARE_UNIT = 2.0 ** 32         # joined log probabilities are multiples of 1 / RARE_UNIT: sums don't depend on order
FREQUENT = 500_000            # words sent to tasks
COUNT_LEVELS = 1 << 16
FOLDS = 10


def fold(key: str | Column) -> Column:
    """CRC32 of the key as text, modulo ``FOLDS``; fold 0 is held out."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % FOLDS


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) code of every position of the texts and of their ends:
    ``ORDER`` context bytes and the byte itself, big-endian. Contexts before the first
    byte are ends. Also the position of the first code of every text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets) + 1
    first = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    stream = np.full(first[-1] + ORDER, END, np.uint64)
    at = np.ones(first[-1], bool)
    at[first[1:] - 1] = False
    stream[ORDER:][at] = raw
    code = stream[ORDER:].copy()
    for k in range(1, ORDER + 1):
        code |= stream[ORDER - k:len(stream) - k] << np.uint64(8 * k)
    every = np.uint64((1 << 8 * (ORDER + 1)) - 1)
    for k in range(ORDER):                   # a text's start sees no bytes of the text before
        here = first[:-1][sizes > k] + k
        keep = np.uint64((1 << 8 * (k + 1)) - 1)
        code[here] = (code[here] & keep) | (every & ~keep)
    return code, first


class Trie:
    """Successor counts of all contexts up to ``ORDER`` bytes, as sorted arrays."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray,
                 shorter: dict[int, tuple[np.ndarray, np.ndarray]] | None = None,
                 below: list[dict] = (), deepest: int = ORDER) -> None:
        """``codes``: ascending distinct (context, byte) codes of the order ``deepest``.
        ``shorter``: by length of context, those that are not the sums of longer ones.
        ``below``: the last orders, where they are made already."""
        self.orders = []                     # from the deepest to the empty context
        keys, n = codes.astype(np.uint64), counts.astype(np.float64)
        for depth in range(deepest, len(below) - 1, -1):
            if shorter and depth in shorter:
                keys, n = shorter[depth][0].astype(np.uint64), shorter[depth][1].astype(np.float64)
            keys, where = np.unique(keys & np.uint64((1 << 8 * (depth + 1)) - 1), return_inverse=True)
            n = np.bincount(where, n, len(keys)) if len(keys) else np.zeros(0)
            contexts, begin = np.unique(keys >> np.uint64(8), return_index=True)
            order = {"keys": keys, "n": n, "contexts": contexts, "begin": begin,
                     "total": np.add.reduceat(n, begin) if len(keys) else np.zeros(0),
                     "distinct": np.diff(np.append(begin, len(keys))).astype(np.float64),
                     "seen": np.zeros(len(contexts))}
            self._append(order, depth)
        if below:                            # those are linked among themselves
            self._append(below[0], len(below) - 1)
            self.orders += below[1:]

    def _append(self, order: dict, depth: int) -> None:
        if self.orders and len(self.orders[-1]["keys"]):
            # What the successors of a longer context weigh in this one.
            long = self.orders[-1]
            at = np.searchsorted(order["keys"], long["keys"] & np.uint64((1 << 8 * (depth + 1)) - 1))
            long["seen"] = np.add.reduceat(order["n"][at], long["begin"])
        self.orders.append(order)

    @classmethod
    def of(cls, orders: list[dict]) -> "Trie":
        trie = cls.__new__(cls)
        trie.orders = orders
        return trie

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the byte after its context, for distinct codes."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))         # codes not predicted yet
        gone_n, gone_k = np.zeros(len(codes)), np.zeros(len(codes))   # excluded weight, symbols
        for i, order in enumerate(self.orders):
            if not len(left) or not len(order["keys"]):
                continue
            key = codes[left].astype(np.uint64) & np.uint64((1 << 8 * (ORDER - i + 1)) - 1)
            context = key >> np.uint64(8)
            c = np.minimum(np.searchsorted(order["contexts"], context), len(order["contexts"]) - 1)
            known = order["contexts"][c] == context
            k = np.minimum(np.searchsorted(order["keys"], key), len(order["keys"]) - 1)
            hit = known & (order["keys"][k] == key)
            total = order["total"][c] - gone_n[left]
            fresh = order["distinct"][c] - gone_k[left]
            scale = np.maximum(total + fresh, 1e-300)
            out[left[hit]] += np.log10(order["n"][k[hit]] / scale[hit])
            miss = known & ~hit
            some = miss & (fresh > 0)        # all excluded: the escape is certain
            out[left[some]] += np.log10(fresh[some] / scale[some])
            gone_n[left[miss]] = order["seen"][c[miss]]
            gone_k[left[miss]] = order["distinct"][c[miss]]
            left = left[~hit]
        out[left] -= np.log10(SYMBOLS - gone_k[left])
        return out


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        for i, j in pieces(off, 1 << 22):
            code, _ = grams(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            u, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(n)], ["code", "n"])


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest n such that at most ``most`` rows of ``counts`` have as many."""
    levels = (counts.groupBy(F.least(F.col("n"), F.lit(COUNT_LEVELS)).alias("level"))
              .agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).orderBy(F.desc("level")).collect())
    rows, least = 0, 1
    for row in levels:                       # at most COUNT_LEVELS rows
        rows += row["rows"]
        if rows > most:
            # Within the top level, only so many rows can have that share of the total.
            return row["n"] // most + 1 if row["level"] == COUNT_LEVELS else row["level"] + 1
        least = row["level"]
    return min(least, 1)


def sorted_arrays(counts: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys (as unsigned, ascending) and counts of a bounded frame, as plain arrays."""
    table = counts.select(key, "n").toArrow()
    keys, n = table.column(key).to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _used_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, byte) codes with their count in training texts and in all texts."""
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        training = b.column("training").to_numpy(zero_copy_only=False).astype(bool)
        for i, j in pieces(off, 1 << 22):
            code, first = grams(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            learn = np.repeat(training[i:j], np.diff(first))
            for part, factor in ((code[learn], 1), (code[~learn], 0)):
                if len(part):
                    u, n = np.unique(part, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u.astype(np.int64)), pa.array(n * factor), pa.array(n)], ["code", "n", "used"])


def probabilities(texts: DataFrame) -> DataFrame:
    """``code``, ``used`` (its count in all texts) and ``log10`` (exact) of every (context,
    byte) code that the column ``text`` has, under the trie of all rows with ``training``."""
    spark = texts.sparkSession
    counts = materialize(texts.select("text", "training").mapInArrow(_used_counts, "code long, n long, used long")
                         .groupBy("code").agg(F.sum("n").alias("n"), F.sum("used").alias("used")))
    short = (counts.filter("n > 0").groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (WHOLE + 1)) - 1)).alias("code"))
             .agg(F.sum("n").alias("n")))
    below = spark.sparkContext.broadcast(Trie(*sorted_arrays(short, "code"), deepest=WHOLE).orders)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(code: np.ndarray, n: np.ndarray, used: np.ndarray) -> pa.RecordBatch:
            order = np.argsort(code)
            code, n, used = code[order].view(np.uint64), n[order], used[order]
            log10 = Trie(code[n > 0], n[n > 0], below=below.value).log10(code)
            return pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(used), pa.array(log10)], ["code", "used", "log10"])

        kept: list[list[np.ndarray]] = []
        rows = 0
        for b in batches:
            kept.append([b.column(c).to_numpy(zero_copy_only=False) for c in ("dealt", "code", "n", "used")])
            rows += b.num_rows
            if rows >= CHUNK:
                dealt, *rest = (np.concatenate(x) for x in zip(*kept))
                cut = int(np.searchsorted(dealt, dealt[-1]))      # the last contexts may go on
                if cut:
                    yield of(*(x[:cut] for x in rest))
                kept, rows = [[x[cut:] for x in (dealt, *rest)]], len(dealt) - cut
        if rows:
            yield of(*(np.concatenate(x) for x in list(zip(*kept))[1:]))

    dealt = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * DEALT) - 1))
    return materialize(counts.withColumn("dealt", dealt).repartition("dealt").sortWithinPartitions("dealt")
                       .mapInArrow(run, "code long, used long, log10 double"))


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values, powers = byte_values(), Powers()
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        raw, found = lower(raw), []
        for i, j in pieces(off):
            found.append(word_hashes(raw[off[i]:off[j]], off[i:j + 1] - off[i], values, powers)[0])
        u, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["word", "n"])


def score(docs: DataFrame, codes: tuple[np.ndarray, np.ndarray], words: tuple[np.ndarray, np.ndarray],
          key: str = "doc_id") -> DataFrame:
    """Per text: ``row`` (a number of its own), ``n_words``, and of the words sent along
    (hashes, log10 of count + 0.1) how many it has and their sum, with the hashes of all
    other words; of the (context, byte) codes sent along (with their log10 probability)
    the sum as ``score``, with all other codes."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((*codes, *words))

    def found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        k = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        return k, known[k] == asked

    def lists(of: np.ndarray, counts: np.ndarray) -> pa.Array:
        return pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64()), pa.array(of.view(np.int64))
        ).cast(pa.list_(pa.int64()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, log10, known, log_count = model.value
        log10, log_count = np.append(log10, 0.0), np.append(log_count, 0.0)
        values, powers = byte_values(), Powers()
        for b in batches:
            raw, off = as_bytes(b.column("text"))
            ids, low = b.column("key"), lower(raw)
            for i, j in pieces(off, 1 << 21):
                at = off[i:j + 1] - off[i]
                code, first = grams(raw[off[i]:off[j]], at)
                u, where = np.unique(code, return_inverse=True)
                k, hit = found(sent, u)
                ppm = np.add.reduceat(np.where(hit, log10[k], 0.0)[where], first[:-1])
                other = ~hit[where]
                h, w = word_hashes(low[off[i]:off[j]], at, values, powers)
                n = np.diff(w)
                k, hit = found(known, h)
                # Text by text, so that equal texts get equal bits wherever they stand.
                logs, some = np.zeros(len(n)), n > 0
                if some.any():
                    logs[some] = np.add.reduceat(np.where(hit, log_count[k], 0.0), w[:-1][some])
                rare = np.diff(np.concatenate([[0], np.cumsum(~hit)])[w])
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(i, j - i), ids.slice(i, j - i), pa.array(n), pa.array(n - rare), pa.array(logs),
                     lists(h[~hit], rare), lists(code[other], np.add.reduceat(other.astype(np.int64), first[:-1])),
                     pa.array(ppm)],
                    ["row", "key", "n_words", "n_frequent", "logs", "rare", "codes", "score"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), "text").mapInArrow(
        run, "row long, key long, n_words long, n_frequent long, logs double, rare array<long>, codes array<long>, score double")


# --- registered query -------------------------------------------------------------------


def op9_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    training = docs.filter(fold("doc_id") != 0)
    entries = probabilities(docs.select("text", (fold("doc_id") != 0).alias("training")))
    least_used = least_count(entries.select(F.col("used").alias("n")), MAX_ENTRIES)
    codes = sorted_arrays(entries.filter(F.col("used") >= least_used).select("code", F.col("log10").alias("n")), "code")

    # Exact word counts of the training texts; a text's end is a token too.
    counts = materialize(training.select("text").mapInArrow(_word_counts, "word long, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")))
    row = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_docs = training.count()
    total, distinct = (row["n"] or 0) + n_docs, row["v"] + (1 if n_docs else 0)
    least = least_count(counts, FREQUENT)
    frequent, n = sorted_arrays(counts.filter(F.col("n") >= least), "word")
    sent = frequent, np.log10(n + 0.1)

    scored = materialize(score(docs, codes, sent))
    others = (scored.select("row", F.explode("codes").alias("code"))
              .join(entries.filter(F.col("used") < least_used)
                    .select("code", (F.round(F.col("log10") * RARE_UNIT) / RARE_UNIT).alias("log10")), "code")
              .groupBy("row").agg(F.sum("log10").alias("others")))
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("tf"))
    seen = (rare.join(counts.filter(F.col("n") < least), "word").groupBy("row")
            .agg(F.sum("tf").alias("n_seen"), F.sum(F.col("tf") * F.round(F.log10(F.col("n") + 0.1) * RARE_UNIT) / RARE_UNIT).alias("seen")))
    scale = float(np.log10(total + 0.1 * (distinct + 1)))
    end = float(np.log10(n_docs + 0.1))
    n_seen, n_tokens = F.coalesce(F.col("n_seen"), F.lit(0)), F.col("n_words") + 1
    unseen = F.col("n_words") - F.col("n_frequent") - n_seen
    return (scored.drop("rare", "codes").join(seen, "row", "left").join(others, "row", "left").select(
        F.col("key").alias("doc_id"), (fold("key") == 0).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("n_frequent") + n_seen + (1 if n_docs else 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce(F.col("seen"), F.lit(0.0)) + unseen * F.lit(float(np.log10(0.1)))
         + F.lit(end) - n_tokens * F.lit(scale)).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("others"), F.lit(0.0))).alias("score")))


QUERIES = {"op9_ppm_score": op9_ppm_score}
ORACLE: dict[str, str] = {}
