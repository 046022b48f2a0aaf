"""Removal of word passages that recur across documents, located by Aho-Corasick automata.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document of a
smaller key. Windows are judged on the input.

1. Candidates. Every window has a minimiser, the smallest hash of its ``GRAM``-word runs,
   so equal windows have equal ones, and neighbouring windows mostly share theirs: they are a
   group. Minimisers of two documents or more are counted out with combined minima and maxima,
   and only stretches of text whose windows have such a minimiser go on.
2. Windows that occur under two keys get an owner, the smallest key that holds them. Where all
   groups of a minimiser are made of the same words, that is the minimiser's smallest key.
   Only the windows of the other minimisers are compared one by one, by their hashes. A run of
   neighbouring windows of one owner is a passage of the document that follows it.
3. Passages are confirmed and located by automata over word numbers. Distinct passages are
   the patterns; they are dealt by owner to shards of about ``SHARD_WORDS`` words, an owner
   with more of them to several. A shard compiles its automaton, then streams the owners'
   stretches through it: a passage found in its owner is a repeat wherever it was cut from.
4. The automaton compares words, not hashes. A passage not found whole is tried window by
   window, as its parts may stand apart in the owner; windows that are still not found (two
   windows of one hash) are settled by grouping the windows themselves.
5. Per document the occurrences are merged and cut out.

Nothing is gathered by passage: a passage in a third of all documents is a combined minimum
in step 2, one pattern in step 3, and rows that are only filtered otherwise.

Defined results: null has no words; texts shorter than a window lose nothing; rows without a
key come after all keys; rows of one key are no smaller than each other, and a window
repeated only inside them stays; rows equal in key and text get one result each; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.arrowtext import Powers, as_bytes, byte_values, mix, pieces, words_of
from strata.llm.common import read, text_or_empty
from strata.session import materialize

WINDOW = 13
GRAM = 5
SHARD_WORDS = 1 << 17         # words of an automaton's patterns, about
BROADCAST_ROWS = 1 << 19      # recurring hashes (8 bytes) that are broadcast; counted first
NO_KEY = (1 << 63) - 1
PATTERN, TEXT = 0, 1


# --- hashes in tasks --------------------------------------------------------------------


def _chained(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words."""
    n = len(h) - k + 1
    out, spread = np.zeros(n, np.uint64), mix(h)
    for j in range(k):
        out += spread[j:j + n] * np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64))
    return mix(out)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values."""
    out, size = x, 1
    while 2 * size <= w:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    return out if size == w else np.minimum(out[:len(x) - w + 1], out[w - size:])


class Text:
    """Windows of the texts of a piece of a batch."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, values: np.ndarray, powers: Powers) -> None:
        self.words, self.starts, self.ends, self.first = words_of(raw, offsets, values, powers)
        self.raw, self.powers, n = raw, powers, len(self.words) - WINDOW + 1
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.text = text[:max(n, 0)]
        #: Windows do not cross texts.
        self.whole = text[WINDOW - 1:] == self.text if n > 0 else np.zeros(0, bool)

    def minimisers(self) -> np.ndarray:
        return _least(_chained(self.words, GRAM), WINDOW - GRAM + 1) if len(self.whole) else np.zeros(0, np.uint64)

    def windows(self) -> np.ndarray:
        return _chained(self.words, WINDOW) if len(self.whole) else np.zeros(0, np.uint64)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Minimisers, and which windows begin a group: neighbours of a text that share theirs."""
        h, new = self.minimisers(), self.whole.copy()
        new[1:] &= (h[1:] != h[:-1]) | (self.text[1:] != self.text[:-1]) | ~self.whole[:-1]
        return h, new

    def group_hashes(self, new: np.ndarray) -> np.ndarray:
        """Hash of all words of every group."""
        heads = np.flatnonzero(new)
        tails = np.searchsorted(ends := np.flatnonzero(self.whole), np.append(heads[1:], len(new))) - 1
        n = len(self.words)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.words) * self.powers.need(n + 1).up[:n], out=total[1:])
        return mix((total[ends[tails] + WINDOW] - total[heads]) * self.powers.down[heads]) if len(heads) else total[:0]

    def stretches(self, chosen: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First and last windows of the runs of chosen ones, cut where ``apart`` changes too."""
        at = np.flatnonzero(chosen & self.whole)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(self.text[at]) > 0)
        if apart is not None:
            new[1:] |= apart[at[1:]] != apart[at[:-1]]
        return at[new], at[np.append(new[1:], True)] if len(at) else at

    def bytes_of(self, heads: np.ndarray, tails: np.ndarray) -> pa.Array:
        return pa.array([self.raw[i:j].tobytes() for i, j in zip(self.starts[heads], self.ends[tails + WINDOW - 1])], pa.binary())


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Text]]:
    values, powers = byte_values(), Powers()
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        for i, j in pieces(off):
            yield b, i, Text(raw[off[i]:off[j]], off[i:j + 1] - off[i], values, powers)


def _group_rows(column: str, *, words: bool = False):
    """The minimiser of every group, and with ``words`` the hash of its words, with the text's ``column``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, t in _texts(batches):
            h, new = t.groups()
            of = [h[new], t.group_hashes(new)] if words else [h[new]]
            yield pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in of], b.column(column).take(pa.array(t.text[new] + i))],
                                             [*["hash", "words"][:len(of)], column])

    return run


def _window_rows(column: str):
    """Hashes of the windows whose group has no owner yet, without repeats of neighbours, with the
    stretch's ``column``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, t in _texts(batches):
            h, new = t.windows(), t.whole & ~_known(t, i, b.column("owners"))[0]
            new[1:] &= (h[1:] != h[:-1]) | (t.text[1:] != t.text[:-1]) | ~new[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), b.column(column).take(pa.array(t.text[new] + i))],
                                             ["hash", column])

    return run


def _known(t: Text, i: int, owners: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the windows' groups have an owner, and which, from the ``owners`` of a stretch's groups."""
    flat = owners.slice(i, len(t.first) - 1).flatten()
    if not len(flat):
        return np.zeros(len(t.whole), bool), np.zeros(len(t.whole), np.int64)
    group = np.maximum(np.cumsum(t.groups()[1]) - 1, 0)
    return flat.is_valid().to_numpy(zero_copy_only=False)[group], flat.fill_null(0).to_numpy()[group]


def _by_text(t: Text, i: int, wanted: pa.ListArray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``hashes`` (of the windows) are in their own text's list, and where in the
    flattened lists. Text numbers are mixed into the hashes, so one search serves all."""
    wanted = wanted.slice(i, len(t.first) - 1)
    lists = wanted.flatten()
    flat = (lists.field("hash") if isinstance(lists, pa.StructArray) else lists).to_numpy().view(np.uint64)
    sizes = np.diff(wanted.offsets.to_numpy())
    if not len(flat) or not len(hashes):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    own = lambda h, text: mix(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    listed = own(flat, np.repeat(np.arange(len(sizes)), sizes))
    order = np.argsort(listed)
    asked = own(hashes, t.text)
    at = np.minimum(np.searchsorted(listed, asked, sorter=order), len(order) - 1)
    return listed[order[at]] == asked, order[at]


STRETCHES = "key long, text_id long, start int, owners array<long>, text binary"


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a document whose windows have one of its ``wanted`` minimisers, with the owner
    of every group, null where its windows are to be compared."""
    for b, i, t in _texts(batches):
        wanted, (h, new) = b.column("wanted"), t.groups()
        found, at = _by_text(t, i, wanted, h)
        heads, tails = t.stretches(found)
        text, groups = t.text[heads], np.flatnonzero(new & found)
        owners = wanted.slice(i, len(t.first) - 1).flatten().field("owner").take(pa.array(at[groups]))
        owners = pa.ListArray.from_arrays(pa.array(np.searchsorted(groups, np.append(heads, len(new))).astype(np.int32)), owners)
        at = pa.array(text + i)
        yield pa.RecordBatch.from_arrays(
            [b.column("key").take(at), b.column("text_id").take(at), pa.array((heads - t.first[text]).astype(np.int32)),
             owners, t.bytes_of(heads, tails)], ["key", "text_id", "start", "owners", "text"])


PASSAGES = "owner long, key long, text_id long, start int, n int, text binary"
P_NAMES = [p.split()[0] for p in PASSAGES.split(", ")]


def _passages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows of one owner, by the ``owners`` of a stretch's groups and, where they are
    null, the ``wanted`` (hash, owner) of its windows."""
    for b, i, t in _texts(batches):
        wanted = b.column("wanted")
        known, owner = _known(t, i, b.column("owners"))
        found, at = _by_text(t, i, wanted, t.windows())
        listed = wanted.slice(i, len(t.first) - 1).flatten()
        if len(listed):
            owner = np.where(known, owner, listed.field("owner").to_numpy()[at])
        found |= known
        if not found.any():
            continue
        heads, tails = t.stretches(found, owner)
        text = t.text[heads]
        rows = pa.array(text + i)
        start = b.column("start").take(rows).to_numpy() + (heads - t.first[text])
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[heads]), b.column("key").take(rows), b.column("text_id").take(rows), pa.array(start.astype(np.int32)),
             pa.array((tails - heads + WINDOW).astype(np.int32)), t.bytes_of(heads, tails)], P_NAMES)


def _single_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages taken apart into their windows."""
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for b in batches:
        rows = []
        for *of, start, n, text in zip(*(b.column(c).to_pylist() for c in P_NAMES)):
            words = text.split()
            rows += [(*of, start + i, WINDOW, b" ".join(words[i:i + WINDOW])) for i in range(n - WINDOW + 1)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], P_NAMES)


# --- automata ---------------------------------------------------------------------------


class Shard:
    """An Aho-Corasick automaton over word numbers, whose patterns are passages with their
    owners."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.patterns: list[tuple[int, bytes]] = []            # owner, passage
        self.same: list[list[int]] = []                        # patterns of equal words
        self.found = bytearray()
        self.ready = False

    def add(self, owner: int, text: bytes) -> None:
        ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split())
        if self.automaton.exists(ids):
            self.same[self.automaton.get(ids)].append(len(self.patterns))
        else:
            self.automaton.add_word(ids, len(self.same))
            self.same.append([len(self.patterns)])
        self.patterns.append((owner, text))
        self.found.append(0)

    def stream(self, key: int, text: bytes) -> None:
        """Marks the patterns that a text of ``key`` holds, of owners that are no smaller."""
        if not self.patterns:
            return
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        for _, k in self.automaton.iter(tuple(self.numbers.get(w, 0) for w in text.split())):
            for p in self.same[k]:
                if key <= self.patterns[p][0]:
                    self.found[p] = 1

    def missing(self) -> pa.RecordBatch:
        rows = [p for p, f in zip(self.patterns, self.found) if not f]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                          ["owner", "text"])


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compiles the automaton of every shard and streams its texts; rows come by shard,
    patterns first. Returns the passages that their owner does not hold."""
    current, shard = None, Shard()
    for b in batches:
        for number, role, owner, text in zip(*(b.column(c).to_pylist() for c in ("shard", "role", "owner", "text"))):
            if number != current:
                if current is not None:
                    yield shard.missing()
                current, shard = number, Shard()
            if role == PATTERN:
                shard.add(owner, text)
            else:
                shard.stream(owner, text)
    if current is not None:
        yield shard.missing()


# --- the operator -----------------------------------------------------------------------


def _bounded(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def not_found(passages: DataFrame, owners: DataFrame) -> DataFrame:
    """The distinct passages (``owner``, ``text``) that no text of their owner holds."""
    distinct = materialize(passages.groupBy("owner", "text").agg(F.max("n").alias("n")))
    words = materialize(distinct.groupBy("owner").agg(F.sum("n").alias("words")))
    texts = owners.join(words.select("owner"), "owner", "left_semi")
    load = sum(f.agg(F.sum(c)).first()[0] or 0 for f, c in ((words, "words"), (texts, "n")))
    shards = 1 + load // SHARD_WORDS
    many = materialize(words.filter(F.col("words") > SHARD_WORDS)
                       .select("owner", F.ceil(F.col("words") / SHARD_WORDS).cast("long").alias("split")))
    split = F.coalesce("split", F.lit(1).cast("long"))
    shard = F.pmod(F.xxhash64("owner", "salt"), F.lit(shards)).alias("shard")
    patterns = distinct.join(many, "owner", "left").withColumn("salt", F.pmod(F.xxhash64("text"), split))
    texts = texts.join(many, "owner", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), split - 1)))
    rows = (patterns.select(shard, F.lit(PATTERN).alias("role"), "owner", "text")
            .unionByName(texts.select(shard, F.lit(TEXT).alias("role"), "owner", "text")))
    return materialize(rows.repartition("shard").sortWithinPartitions("shard", "role").mapInArrow(_search, "owner long, text binary"))


def occurrences(docs: DataFrame) -> DataFrame:
    """``key``, ``text_id`` and the ``spans`` (start, end in words) to remove, for every
    document of ``docs`` (key, text_id, text) with any; spans may overlap."""
    document = ["key", "text_id"]
    # Two documents of one number would only lend each other candidates.
    docs = docs.withColumn("doc", F.xxhash64(*document))
    groups = (docs.select("key", "text").mapInArrow(_group_rows("key", words=True), "hash long, words long, key long")
              .groupBy("hash", "words").agg(F.min("key").alias("low"), F.max("key").alias("high")))
    # A minimiser whose groups are all of the same words gives their windows its smallest key.
    shared = materialize(groups.groupBy("hash").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("words").alias("n"))
                         .filter("low < high").select("hash", F.when(F.col("n") == 1, F.col("low")).alias("owner")))
    wanted = (docs.select("doc", "text").mapInArrow(_group_rows("doc"), "hash long, doc long")
              .join(_bounded(shared), "hash").groupBy("doc").agg(F.collect_set(F.struct("hash", "owner")).alias("wanted")))
    stretches = materialize(docs.join(wanted, "doc").select(*document, "text", "wanted").mapInArrow(_candidates, STRETCHES)
                            .withColumn("stretch", F.monotonically_increasing_id()))
    texts = stretches.withColumn("text", F.col("text").cast("string"))

    owned = materialize(texts.select("key", "text", "owners").mapInArrow(_window_rows("key"), "hash long, key long")
                        .groupBy("hash").agg(F.min("key").alias("owner"), F.max("key").alias("last"))
                        .filter("owner < last").select("hash", "owner"))
    wanted = (texts.select("stretch", "text", "owners").mapInArrow(_window_rows("stretch"), "hash long, stretch long")
              .join(owned, "hash").groupBy("stretch").agg(F.collect_list(F.struct("hash", "owner")).alias("wanted")))
    cut = materialize(texts.join(wanted, "stretch", "left").select(*document, "start", "text", "owners", "wanted").mapInArrow(_passages, PASSAGES))
    # Texts of an owner's key, each once.
    owners = materialize(cut.filter("key = owner").groupBy("owner", "text").agg(F.max("n").alias("n")))
    found = cut.filter("key > owner")

    span = [*document, "start", (F.col("start") + F.col("n")).alias("end")]
    passage = ["owner", "text"]
    missing = not_found(found, owners)
    spans = found.join(missing, passage, "left_anti").select(*span)
    if not missing.isEmpty():
        windows = materialize(found.join(missing, passage, "left_semi").select(*P_NAMES).mapInArrow(_single_windows, PASSAGES))
        missing = not_found(windows, owners)
        lone = windows.join(missing, passage, "left_semi")
        late = lone.join(lone.groupBy("text").agg(F.min("key").alias("first")), "text").filter(F.col("key") > F.col("first"))
        spans = (spans.unionByName(windows.join(missing, passage, "left_anti").select(*span))
                 .unionByName(late.select(*span)))
    return spans.groupBy(*document).agg(F.collect_set(F.struct("start", "end")).alias("spans"))


CUT = "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string"


def _cut(keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = as_bytes(b.column("text"))
            rows: list[tuple] = []
            for d, (key, spans) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("spans"))):
                words = raw[off[d]:off[d + 1]].tobytes().split()
                n = len(words)
                if spans.is_valid:
                    gone = np.zeros(n + 1, np.int64)
                    np.add.at(gone, spans.values.field("start").to_numpy(), 1)
                    np.add.at(gone, spans.values.field("end").to_numpy(), -1)
                    stays = np.cumsum(gone)[:n] == 0
                    words = [w for w, s in zip(words, stays) if s]
                kept = b" ".join(words)
                rows.append((key, n, n - len(words), kept if keep_text else None, hashlib.sha256(kept).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))],
                    [p.split()[0] for p in CUT.split(", ")])

    return run


def remove_passages(df: DataFrame, *, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per row of ``df``: its key as ``doc_id``, word counts, the ``kept`` words joined
    by spaces (null unless ``keep_text``) and their digest."""
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"),
                     F.xxhash64(text_or_empty(text)).alias("text_id"), text_or_empty(text).alias("text"))
    spans = occurrences(docs)
    return docs.join(spans, ["key", "text_id"], "left").select("doc_id", "text", "spans").mapInArrow(_cut(keep_text), CUT)


# --- registered query -------------------------------------------------------------------


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")


QUERIES = {"op11_phrase_automata": op11_phrase_automata}
ORACLE: dict[str, str] = {}
