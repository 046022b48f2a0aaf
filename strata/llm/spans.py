"""Exact removal of repeated byte strings across the corpus, by suffix sorting.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts earlier: in a
document of a smaller key, or earlier in the same one. All documents count in full, and
strings are judged on the input.

1. Every window of WIDTH bytes has an anchor, the position in it whose 32-byte hash is
   smallest, so equal windows have equal anchors at equal offsets. About one position in
   40 is an anchor. Occurrences whose whole surroundings are equal (all windows around
   the anchor) are one class: all but the earliest are repeats, and only the earliest
   goes on. This is done in every batch before anything travels, then for the corpus
   along sorted runs of the anchor's hash, which need no more memory than one row.
2. Classes that share an anchor may still share some of their windows. Their
   surroundings (at most 168 bytes) are fetched and, anchor by anchor, suffix-sorted:
   equal windows stand together in the suffix array, and all but the earliest are
   repeats. Surroundings are cut to the windows that could be shared, and one that is part
   of an earlier one at the same offset is a repeat without sorting.
3. An anchor with more than ``GROUP`` classes is not gathered: its windows are dealt out
   by their own hash, and the earliest of each is a combined minimum.
4. Per document the repeats are merged and cut out.

Defined results: null counts as empty; texts shorter than WIDTH lose nothing; rows
without a key come after all others; rows with one key are ordered by a hash of their
text, and rows equal in both are one document with one result; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.arrowtext import PIECE_BYTES, Powers, as_bytes, byte_values, mix, pieces
from strata.llm.common import read, text_or_empty
from strata.llm.gsaca import repeated_windows
from strata.session import materialize

WIDTH = 100
GRAM = 32                     # bytes of an anchor
REACH = WIDTH - GRAM          # bytes that a window can have before its anchor
GROUP = 2_048                 # classes of one anchor that are suffix-sorted together
READY = 4_096                 # surroundings whose windows are hashed at once
NO_KEY = (1 << 63) - 1

REPEAT, CLASS, WINDOW = 0, 1, 2


def _slide(x: np.ndarray, w: int, better) -> np.ndarray:
    """better(x[i], ..., x[i + w - 1]) for every i, by doubling."""
    size, out = 1, x
    while size * 2 <= w:
        out = better(out[:-size], out[size:])
        size *= 2
    return out if size == w else better(out[:len(x) - w + 1], out[w - size:w - size + len(x) - w + 1])


def anchors(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray, powers: Powers) -> dict[str, np.ndarray]:
    """Anchors of the texts: text number, hash, hash of the surroundings, and where the
    surroundings start, the anchor stands and the surroundings end within the text."""
    none = np.zeros(0, np.int64)
    empty = {k: none for k in ("text", "start", "at", "end")} | {k: none.view(np.uint64) for k in ("hash", "around")}
    n = len(raw)
    if n < WIDTH:
        return empty
    powers.need(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values[raw] * powers.up[:n], out=total[1:])
    gram = mix((total[GRAM:] - total[:-GRAM]) * powers.down[:n - GRAM + 1])
    w = REACH + 1
    least = _slide(gram, w, np.minimum)              # of the window that starts here
    inside = np.zeros(n + 1, np.int32)               # windows may not cross texts
    np.add.at(inside, np.minimum(offsets[:-1], n), 1)
    sizes = np.diff(offsets)
    stop = np.where(sizes >= WIDTH, offsets[1:] - WIDTH + 1, offsets[:-1])
    np.add.at(inside, np.minimum(stop, n), -1)
    valid = np.cumsum(inside)[:len(least)] > 0
    own = np.where(valid, least, np.uint64(0))
    padded = np.concatenate([np.zeros(w - 1, np.uint64), own, np.zeros(w - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, w, np.maximum) == gram)
    at = at[gram[at] != 0]
    text = np.searchsorted(offsets, at, "right") - 1
    first, last = offsets[text], offsets[text + 1]
    start, end = np.maximum(at - REACH, first), np.minimum(at + WIDTH, last)
    around = mix((total[end] - total[start]) * powers.down[start]) + (
        (at - start) * 1024 + (end - at)).astype(np.uint64)
    return {"text": text, "hash": gram[at], "around": mix(around), "start": start - first, "at": at - first, "end": end - first}


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(new[1:], True)]


ROW = "kind int, hash long, around long, key long, text_id long, start int, at int, end int"
NAMES = [p.split()[0] for p in ROW.split(", ")]


def _rows(kind, hash_, around, key, text_id, start, at, end) -> pa.RecordBatch:
    n = len(key)
    fill = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))      # noqa: E731
    return pa.RecordBatch.from_arrays(
        [fill(kind, np.int32), fill(hash_, np.int64), fill(around, np.int64), fill(key, np.int64),
         fill(text_id, np.int64), fill(start, np.int32), fill(at, np.int32), fill(end, np.int32)], NAMES)


def _repeats(keys: np.ndarray, ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Repeat rows, merged per document; dealt by document, as they pass through later
    shuffles among the anchors."""
    order = np.lexsort((start, ids, keys))
    keys, ids, start, end = keys[order], ids[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(keys):
        return
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    # Texts far apart on one line, so that one merge serves all of them.
    shift = (np.cumsum(new) - 1) << 32
    s, e = merged(start + shift, end + shift)
    which = np.flatnonzero(new)[s >> 32]
    yield _rows(REPEAT, mix(ids[which].view(np.uint64) + keys[which].view(np.uint64)).view(np.int64), 0,
                keys[which], ids[which], s & 0xFFFFFFFF, 0, e & 0xFFFFFFFF)


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 inside a batch: the earliest occurrence of every class, repeats for the rest."""
    values, powers = byte_values(), Powers()
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        keys, ids = b.column("key").to_numpy(), b.column("text_id").to_numpy()
        found = []
        for i, j in pieces(off, PIECE_BYTES):
            a = anchors(raw[off[i]:off[j]], off[i:j + 1] - off[i], values, powers)
            a["text"] = a["text"] + i
            found.append(a)
        if not found:
            continue
        a = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
        key, text_id = keys[a["text"]], ids[a["text"]]
        order = np.lexsort((a["at"], text_id, key, a["around"], a["hash"]))
        a = {k: v[order] for k, v in a.items()}
        key, text_id = key[order], text_id[order]
        first = np.ones(len(order), bool)
        first[1:] = (a["hash"][1:] != a["hash"][:-1]) | (a["around"][1:] != a["around"][:-1])
        same = np.zeros(len(order), bool)     # the very occurrence again: a row listed twice
        same[1:] = ~first[1:] & (key[1:] == key[:-1]) & (text_id[1:] == text_id[:-1]) & (a["at"][1:] == a["at"][:-1])
        rest = ~first & ~same
        yield _rows(CLASS, a["hash"][first].view(np.int64), a["around"][first].view(np.int64), key[first],
                    text_id[first], a["start"][first], a["at"][first], a["end"][first])
        yield from _repeats(key[rest], text_id[rest], a["start"][rest], a["end"][rest])


def _class_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 for the corpus, on rows sorted by (hash, around, key, text_id, at): repeats
    for all but the first of a class, and the firsts of hashes with several classes. Only
    the first row of the current hash and the last row are carried between batches."""
    before: dict[str, int] | None = None      # last row seen
    waiting: dict[str, int] | None = None     # first row of a hash that has had one class so far
    for b in batches:
        if not b.num_rows:
            continue
        c = {n: b.column(n).to_numpy() for n in NAMES}
        passing = c["kind"] == REPEAT
        if passing.any():
            yield _rows(*[c[n][passing] for n in NAMES])
            c = {n: v[~passing] for n, v in c.items()}
        if not len(c["key"]):
            continue
        if before is not None:
            c = {n: np.concatenate([[before[n]], v]).astype(v.dtype) for n, v in c.items()}
        new_hash = np.ones(len(c["key"]), bool)
        new_hash[1:] = c["hash"][1:] != c["hash"][:-1]
        first = new_hash.copy()
        first[1:] |= c["around"][1:] != c["around"][:-1]
        same = np.zeros(len(first), bool)
        same[1:] = ~first[1:] & (c["key"][1:] == c["key"][:-1]) & (c["text_id"][1:] == c["text_id"][:-1]) & (c["at"][1:] == c["at"][:-1])
        skip = 0 if before is None else 1      # that row has had its turn
        rest = ~first & ~same
        rest[:skip] = False
        yield from _repeats(c["key"][rest], c["text_id"][rest], c["start"][rest], c["end"][rest])
        # A first is sent on when its hash has another: the later ones now, a hash's first
        # one once a second class turns up, maybe in a later batch.
        later = np.flatnonzero(first & ~new_hash)
        later = later[later >= skip]
        if len(later):
            run = np.maximum.accumulate(np.where(new_hash, np.arange(len(first)), 0))[later]
            heads = np.unique(run)
            if before is not None:
                if heads[0] == 0 and waiting is not None:
                    yield _rows(*[np.array([waiting[n]]) for n in NAMES])
                if heads[0] == 0:
                    waiting, heads = None, heads[1:]
            take = np.concatenate([heads, later])
            yield _rows(*[c[n][take] for n in NAMES])
        final = np.flatnonzero(new_hash)[-1]
        if final > 0 or before is None:        # a hash began in this batch
            open_ = not (len(later) and later[-1] > final)
            waiting = {n: v[final] for n, v in c.items()} if open_ else None
        before = {n: v[-1] for n, v in c.items()}


AROUND = "hash long, key long, text_id long, start int, at int, bytes binary"


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of a document's classes, as bytes."""
    names = [p.split()[0] for p in AROUND.split(", ")]
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        for d, (key, text_id, wanted) in enumerate(zip(b.column("key").to_pylist(), b.column("text_id").to_pylist(),
                                                       b.column("wanted"))):
            text = raw[off[d]:off[d + 1]].tobytes()
            w = wanted.values
            h, s, a, e = (w.field(n).to_numpy() for n in ("hash", "start", "at", "end"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(np.full(len(h), key)), pa.array(np.full(len(h), text_id)), pa.array(s),
                 pa.array(a), pa.array([text[i:j] for i, j in zip(s.tolist(), e.tolist())], pa.binary())], names)


def _window_hashes(bytes_: list[bytes], values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every window of every string, with the string's number and the start."""
    off = np.concatenate([[0], np.cumsum([len(x) for x in bytes_])])
    raw = np.frombuffer(b"".join(bytes_), np.uint8)
    powers.need(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * powers.up[:len(raw)], out=total[1:])
    n = np.diff(off) - WIDTH + 1
    which = np.repeat(np.arange(len(bytes_)), n)
    start = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = off[which] + start
    return mix((total[at + WIDTH] - total[at]) * powers.down[at]), which, start


def sort_groups(rows: list[tuple[int, int, int, int, int, bytes]], values: np.ndarray, powers: Powers
                ) -> Iterator[tuple[int, int, int, int]]:
    """Step 2 for whole groups: (key, text_id, start, end) of all repeats among the
    surroundings (hash, key, text_id, start, at, bytes), given by hash in order of occurrence."""
    hashes, which, start = _window_hashes([r[5] for r in rows], values, powers)
    aligned = start - np.array([r[4] - r[3] for r in rows])[which]        # start relative to the anchor
    anchor = np.array([r[0] for r in rows], np.int64).view(np.uint64)[which]
    _, where, count = np.unique(mix(hashes + aligned.astype(np.uint64)) + mix(anchor),
                                return_inverse=True, return_counts=True)
    shared = count[where] > 1
    if not shared.any():
        return
    which, start = which[shared], start[shared]
    heads = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    tails = np.append(heads[1:], len(which)) - 1
    current, kept = None, []
    for r, i, z in zip(which[heads].tolist(), start[heads].tolist(), start[tails].tolist()):
        hash_, key, text_id, s, at, whole = rows[r]
        if hash_ != current:
            yield from _sort_texts(kept)
            current, kept = hash_, []
        part, offset = whole[i:z + WIDTH], i - (at - s)
        n = len(part)
        for other, base, *_ in kept:          # part of an earlier one, at the same offset
            if offset >= base and other[offset - base:offset - base + n] == part:
                yield key, text_id, s + i, s + i + n
                break
        else:
            kept.append((part, offset, key, text_id, s + i))
    yield from _sort_texts(kept)


def _sort_texts(kept: list[tuple[bytes, int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Suffix-sorts texts (bytes, offset, key, text_id, start) and yields all occurrences of
    their windows but the earliest of each."""
    if len(kept) < 2:
        return
    for group in repeated_windows([k[0] for k in kept], WIDTH):
        places = sorted((kept[t][2], kept[t][3], kept[t][4] + i) for t, i in group)
        for key, text_id, s in places[1:]:
            if (key, text_id, s) != places[0]:
                yield key, text_id, s, s + WIDTH


def _sorted_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 on rows sorted by (hash, key, text_id, at); a group that grows beyond GROUP
    leaves as windows (step 3)."""
    values, powers = byte_values(), Powers()
    ready: list[tuple] = []                   # whole groups
    group: list[tuple] = []
    hot = False

    def sort_ready() -> Iterator[pa.RecordBatch]:
        found = np.array(list(sort_groups(ready, values, powers)) if ready else [], np.int64).reshape(-1, 4)
        yield from _repeats(found[:, 0], found[:, 1], found[:, 2], found[:, 3])

    def windows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, which, start = _window_hashes([r[5] for r in rows], values, powers)
        col = lambda k: np.array([r[k] for r in rows])[which]             # noqa: E731
        second = mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) + (start - col(4) + col(3)).astype(np.uint64)
        yield _rows(WINDOW, h.view(np.int64), (second + np.uint64(rows[0][0] & 0xFFFFFFFF)).view(np.int64),
                    col(1), col(2), col(3) + start, 0, col(3) + start + WIDTH)

    for b in batches:
        columns = [b.column(n).to_pylist() for n in ("hash", "key", "text_id", "start", "at", "bytes")]
        for row in zip(*columns):
            if group and row[0] != group[0][0]:
                if hot:
                    yield from windows(group)
                elif len(group) > 1:
                    ready.extend(group)
                group, hot = [], False
                if len(ready) >= READY:
                    yield from sort_ready()
                    ready = []
            if group and row[:5] == group[-1][:5]:
                continue                      # a row listed twice
            group.append(row)
            if len(group) > GROUP:
                hot = True
                yield from windows(group[:-1])
                group = group[-1:]
    if hot and group:
        yield from windows(group)
    elif len(group) > 1:
        ready.extend(group)
    yield from sort_ready()


def repeats(docs: DataFrame) -> DataFrame:
    """``key``, ``text_id`` and the ``spans`` (start, end) to remove, for every document of
    ``docs`` (key, text_id, text) with any; spans may overlap."""
    order = ["hash", "around", "key", "text_id", "at"]
    classes = materialize(docs.select("key", "text_id", "text").mapInArrow(_anchor_rows, ROW)
                          .repartition("hash").sortWithinPartitions(*order).mapInArrow(_class_rows, ROW))
    wanted = (classes.filter(F.col("kind") == CLASS).groupBy("key", "text_id")
              .agg(F.collect_set(F.struct("hash", "start", "at", "end")).alias("wanted")))
    around = docs.join(wanted, ["key", "text_id"]).select("key", "text_id", "text", "wanted").mapInArrow(_fetch, AROUND)
    sorted_ = materialize(around.repartition("hash").sortWithinPartitions("hash", "key", "text_id", "at")
                          .mapInArrow(_sorted_groups, ROW))
    windows = sorted_.filter(F.col("kind") == WINDOW)
    place = F.struct("key", "text_id", "start")
    earliest = windows.groupBy("hash", "around").agg(F.min(place).alias("first"))
    late = windows.join(earliest, ["hash", "around"]).filter(place != F.col("first"))
    spans = (classes.filter(F.col("kind") == REPEAT).unionByName(sorted_.filter(F.col("kind") == REPEAT))
             .unionByName(late.drop("first")))
    return spans.groupBy("key", "text_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def keyed(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the columns by which documents are ordered and told apart."""
    return df.withColumns({"key": F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)),
                           "text_id": F.xxhash64(text_or_empty(text)), "text": text_or_empty(text)})


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _cut(keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = as_bytes(b.column("text"))
            removed, runs, kept, digests = [], [], [], []
            for d, spans in enumerate(b.column("spans")):
                text = raw[off[d]:off[d + 1]].tobytes()
                gone = n = 0
                if spans.is_valid:
                    s, e = merged(*(spans.values.field(x).to_numpy() for x in ("start", "end")))
                    gone, n = int((e - s).sum()), len(s)
                    text = b"".join(text[i:j] for i, j in zip([0, *e.tolist()], [*s.tolist(), len(text)]))
                removed.append(gone)
                runs.append(n)
                kept.append(text if keep_text else None)
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                [p.split()[0] for p in CUT.split(", ")])

    return run


def remove_repeats(df: DataFrame, *, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per row of ``df``: its key as ``doc_id``, byte counts, the ``kept`` bytes
    (null unless ``keep_text``) and their digest. A cut may fall inside a character."""
    docs = keyed(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    spans = repeats(docs)
    return docs.join(spans, ["key", "text_id"], "left").select("doc_id", "text", "spans").mapInArrow(_cut(keep_text), CUT)


# --- registered query -------------------------------------------------------------------


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE: dict[str, str] = {}
