"""How filters interact: what each removes, given the filters that ran before it.

Filters are conditions on a document, each one bit of its failure mask. The mask counts
per part of the corpus are additive, so every order of the filters is read off them.

One filter fails texts that are identical to one of a smaller key. It is decided by a
duplicate prepass: every task sketches the hashes of its texts in a counting Bloom filter
(``PROBES`` cells of one 64-cell block a text, counts stopping at two); the sketches are
merged segment by segment, and what remains is the cells counted twice or more. A text
with a cell counted once is unique for sure. Only the others, true repeats and a few false
alarms, travel: they are grouped by their full text for the smallest key, and the rows
that hold that key are matched by (key, digest), so a text copied into a third of all rows
makes no hot join key. The filter has ``CELLS`` cells for every text, so false alarms do
not grow with the corpus; the table of repeated cells is broadcast up to
``BROADCAST_BYTES``, counted first, and joined by shuffle beyond, with one result.

Defined results: a null text is empty and equal to other empty ones; a null part is the
empty string; a row without a key comes after all keys, and rows of one key are no smaller
than each other; a document is good or toxic if one of its labels says so; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from itertools import permutations
from typing import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ASCII_UPPER, read, text_or_empty, words
from strata.session import materialize

FILTERS = "ABCDE"
CELLS = 16                    # cells of the sketch for every text
PROBES = 3                    # cells that a text counts in
SEGMENT = 1 << 16             # cells merged together
FLUSH = 1 << 20               # texts sketched by a task before it hands on
BROADCAST_BYTES = 64 << 20
NO_KEY = (1 << 63) - 1


# --- duplicate prepass ------------------------------------------------------------------


def _probes(text_hash: str, blocks: int) -> dict[str, Column]:
    """The block of a text's cells, and the cells as bits of a long."""
    bits = F.expr(" | ".join(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({text_hash}, 1), {20 * i}), 64) as int))"
                             for i in range(PROBES)))
    return {"_block": F.pmod(F.col(text_hash), F.lit(blocks)), "_bits": bits}


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells counted once, and twice or more, by segment."""
    def counted(blocks: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        set_ = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        row, bit = np.nonzero(set_)
        cells, n = np.unique(blocks[row] * 64 + bit, return_counts=True)
        segment = cells // SEGMENT
        heads = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        once, twice = [], []
        for i, j in zip(heads, np.append(heads[1:], len(cells))):
            own, again = (cells[i:j] % SEGMENT).astype(np.uint16), n[i:j] > 1
            once.append(own[~again].tobytes())
            twice.append(own[again].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(segment[heads]), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                                         ["segment", "once", "twice"])

    held, n = [], 0
    for b in batches:
        held.append((b.column("_block").to_numpy(), b.column("_bits").to_numpy()))
        n += b.num_rows
        if n >= FLUSH:
            yield from counted(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield from counted(*map(np.concatenate, zip(*held)))


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up sketches, given in the order of segments: the blocks with repeated cells."""
    current, counts = None, np.zeros(SEGMENT, np.uint8)

    def repeated() -> pa.RecordBatch:
        bits = np.packbits(counts > 1, bitorder="little").view(np.int64)
        some = np.flatnonzero(bits)
        return pa.RecordBatch.from_arrays([pa.array(current * (SEGMENT // 64) + some), pa.array(bits[some])],
                                          ["_block", "_repeated"])

    for b in batches:
        for segment, once, twice in zip(*(b.column(c).to_pylist() for c in ("segment", "once", "twice"))):
            if segment != current:
                if current is not None:
                    yield repeated()
                current, counts = segment, np.zeros(SEGMENT, np.uint8)
            for cells, more in ((once, 1), (twice, 2)):
                cells = np.frombuffer(cells, np.uint16)
                counts[cells] = np.minimum(counts[cells] + more, 2)
    if current is not None:
        yield repeated()


def repeated_cells(hashes: DataFrame, text_hash: str, blocks: int) -> DataFrame:
    """``_block`` and ``_repeated`` (bits of the cells counted twice or more)."""
    probed = hashes.select(*[c.alias(n) for n, c in _probes(text_hash, blocks).items()])
    sketches = probed.mapInArrow(_sketch, "segment long, once binary, twice binary")
    return (sketches.repartition("segment").sortWithinPartitions("segment")
            .mapInArrow(_merge, "_block long, _repeated long"))


def mark_repeats(df: DataFrame, *, key: str = "doc_id", text: str = "text", keep: Sequence[str] = (),
                 name: str = "repeat") -> DataFrame:
    """The columns ``keep`` of ``df`` and ``name``: whether the whole text is that of a row
    with a smaller key."""
    blocks = max(1, math.ceil(df.count() * CELLS / 64))
    t = text_or_empty(text)
    hashed = F.xxhash64(t).alias("_h")
    cells = materialize(repeated_cells(df.select(hashed), "_h", blocks))
    if cells.count() * 16 <= BROADCAST_BYTES:
        cells = F.broadcast(cells)
    rows = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("_key"),
                     t.alias("_text"), hashed)
    rows = rows.withColumns(_probes("_h", blocks)).join(cells, "_block", "left")
    possible = F.coalesce(F.col("_repeated").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    # One scan of the texts; only those that may be repeated are written for the exact step.
    rows = materialize(rows.withColumn("_possible", possible).select(
        *keep, "_key", "_possible", F.when(F.col("_possible"), F.sha2("_text", 256)).alias("_digest"),
        F.when(F.col("_possible"), F.col("_text")).alias("_text")))
    firsts = (rows.filter("_possible").groupBy("_digest", "_text").agg(F.min("_key").alias("_key"))
              .select("_digest", "_key", F.lit(True).alias("_first")))
    kept = [F.col(c) for c in keep]
    checked = (rows.filter("_possible").drop("_text").join(firsts, ["_digest", "_key"], "left")
               .select(*kept, F.col("_first").isNull().alias(name)))
    return rows.filter("not _possible").select(*kept, F.lit(False).alias(name)).unionByName(checked)


# --- masks and orders -------------------------------------------------------------------


def failure_mask(conditions: Sequence[Column]) -> Column:
    """Bit k is set if condition k holds; null does not."""
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)]
    return sum(bits[1:], bits[0]).cast("int")


def mask_counts(masks: DataFrame, part: str = "part", mask: str = "mask") -> DataFrame:
    """Documents, good ones and toxic ones (``n``, ``good``, ``toxic``) by part and mask."""
    return masks.groupBy(part, mask).agg(F.count(F.lit(1)).alias("n"), *[
        F.coalesce(F.sum(F.coalesce(c, F.lit(0))), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def audit(counts: DataFrame, filters: str = FILTERS, part: str = "part", mask: str = "mask") -> DataFrame:
    """Every order of the filters, step by step, from the mask counts of every part: a part
    has at most 2 ** len(filters) masks, so this no longer depends on the corpus."""
    steps = [{"filter_order": "".join(order), "step": k + 1, "bit": 1 << filters.index(f),
              "before": sum(1 << filters.index(e) for e in order[:k])}
             for order in permutations(filters) for k, f in enumerate(order)]
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    rows = counts.select(part, mask, "n", "good", "toxic", F.inline(table))
    fails = F.col(mask).bitwiseAND(F.col("bit")) != 0
    earlier = F.col(mask).bitwiseAND(F.col("before")) != 0
    # In 1 / bits of all orders a filter is the first of those that a document fails.
    first = F.expr(f"n * ({math.factorial(len(filters))} div bit_count({mask}))")
    total = lambda when, n="n": F.coalesce(F.sum(F.when(when, F.col(n) if isinstance(n, str) else n)), F.lit(0)).cast("long")
    return rows.groupBy(part, "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col(mask) == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"),
        total(fails, first).alias("shapley"))


def text_conditions(text: str = "text") -> list[Column]:
    """Short, monotonous, shouting, and holding markup signs."""
    t, w = text_or_empty(text), words(text)
    return [F.size(w) < 200,
            100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
            100 * F.regexp_count(t, F.lit("[A-Z]")) > 3 * F.length(t),
            t.rlike("[#$%&*|]")]


def document_masks(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                   part: str = "lang") -> DataFrame:
    """``key``, ``part``, ``mask``, ``good`` and ``toxic`` (0 or 1) of every document."""
    measured = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                           F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                           failure_mask(text_conditions(text)).alias("mask"))
    marked = mark_repeats(measured, key="key", text="text", keep=["key", "part", "mask"])
    known = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    repeat = F.when(F.col("repeat"), 1 << len(text_conditions(text))).otherwise(0)
    return (marked.select("key", "part", (F.col("mask") + repeat).alias("mask")).join(known, "key", "left")
            .select("key", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic")))


# --- registered query -------------------------------------------------------------------


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = document_masks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return audit(mask_counts(masks))


OP12_SQL = f"""
with l as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
m as (
  select doc_id, part,
         (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
         + 4 * (100 * (length(t) - length(translate(t, '{ASCII_UPPER}', ''))) > 3 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * coalesce(min(doc_id) over (partition by t) < coalesce(doc_id, 9223372036854775807), false)::int as mask
  from d),
c as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from m left join l on m.doc_id = l.doc_id group by part, mask),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, unnest(range(1, 6)) as step from o),
b as (
  select *, (1 << (ascii(filter_order[step]) - 65))::int as bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65)))::int as before from s),
x as (
  select *, (mask & bit) <> 0 as fails, (mask & coalesce(before, 0)) <> 0 as earlier from c, b)
select part, filter_order, step::int as step,
       coalesce(sum(n) filter (where not fails and not earlier), 0)::bigint as kept,
       coalesce(sum(n) filter (where fails and not earlier), 0)::bigint as removed,
       coalesce(sum(n) filter (where fails and earlier), 0)::bigint as redundant,
       coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
       coalesce(sum(good) filter (where fails and not earlier), 0)::bigint as good_lost,
       coalesce(sum(toxic) filter (where fails and not earlier), 0)::bigint as toxic_lost,
       sum(coalesce(sum(n) filter (where fails and not earlier), 0)) over (partition by part, bit)::bigint as shapley
from x group by part, filter_order, step, bit
"""

QUERIES = {"op12_filter_audit": op12_filter_audit}
ORACLE = {"op12_filter_audit": OP12_SQL}
