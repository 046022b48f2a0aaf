"""Benchmark decontamination by a hash set of benchmark word windows.

Benchmark items are normalised to lower-case words and cut into windows of ``n``
words (an item of fewer words is one window). Every window of every document is
hashed, joined with the benchmark's windows, and each hit is verified word by word.
Documents, or the words inside hits, are then removed.

The benchmark's windows are broadcast after their bytes are measured and found within
``BROADCAST_BYTES``; a larger benchmark takes the same join without the hint, dealt by
hash. A window is 8 bytes on that side and document texts never travel: only verified
hits are grouped, by document.

Defined results: null or wordless texts have no windows and are never hit; equal rows
get equal results; an empty benchmark hits nothing; columns named like the outputs are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.cascade import window_hash
from strata.llm.common import ascii_lower, read, text_or_empty
from strata.session import materialize

WINDOW = 10
BROADCAST_BYTES = 64 << 20
# Word characters: digits, letters and everything beyond ASCII.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = BREAK.replace("[", "[^", 1)


def normal_words(text: str | Column) -> Column:
    """Lower-cased words of a text (A-Z only are lowered)."""
    return F.array_remove(F.split(ascii_lower(text), BREAK + "+"), "")


def benchmark_windows(bench: DataFrame, n: int = WINDOW, *, item: str = "item_id",
                      text: str = "text") -> DataFrame:
    """Distinct windows of all items: ``hash``, ``n``, ``window`` and its ``items``."""
    items = bench.select(F.col(item).cast("string").alias("item"), normal_words(text).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(n)))
    cut = items.select("item", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
        lambda i: F.slice("w", i, F.col("n")))).alias("window"))
    return cut.groupBy("n", "window").agg(F.collect_set("item").alias("items"))


def _row_key(df: DataFrame, key: str, text: str) -> dict[str, Column]:
    """Row identity that survives repeated keys: null flag, key and text hash."""
    return {"_null": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_text": F.xxhash64(text_or_empty(text))}


def window_hashes(hashes: str, k: int) -> Column:
    """Hashes of all windows of ``k`` words; fewer words than that give none."""
    starts = F.sequence(F.lit(0), F.size(hashes) - k)
    return F.when(F.size(hashes) >= k, F.transform(starts, lambda i: window_hash(F.col(hashes), i, k))
                  ).otherwise(F.array().cast("array<bigint>"))


def windows_of(words: str, hashes: str, k: int) -> Column:
    """The same with the words themselves and where they start."""
    starts = F.sequence(F.lit(0), F.size(hashes) - k)
    cut = F.transform(starts, lambda i: F.struct(
        window_hash(F.col(hashes), i, k).alias("hash"), F.slice(F.col(words), i + 1, k).alias("words"),
        i.alias("at"), F.lit(k).alias("n")))
    return F.when(F.size(hashes) >= k, cut).otherwise(
        F.array().cast("array<struct<hash:bigint,words:array<string>,at:int,n:int>>"))


ROW_KEY = ["_null", "_key", "_text"]


def contamination(docs: DataFrame, bench: DataFrame, n: int = WINDOW, *, key: str = "doc_id",
                  text: str = "text", every: bool = False) -> DataFrame:
    """One row per document with a hit, by ``ROW_KEY``: ``spans`` (disjoint runs of hit
    words as start, end), ``n_hit`` words and the sorted ``items`` found.

    With ``every``, one row per ``ROW_KEY`` of all documents, hit or not, with the document's
    key, its ``n_words`` and ``copies`` (rows that have this key and text) too: texts
    are read and cut into words once for both."""
    windows = materialize(benchmark_windows(bench, n))
    sent_bytes = [F.octet_length(F.array_join(F.col(c).cast("array<string>"), " ")) for c in ("window", "items")]
    size = windows.agg(F.sum(sum(sent_bytes, F.lit(64))).alias("bytes"),
                       F.collect_set("n").alias("lengths")).first()
    lengths = sorted(size["lengths"], reverse=True)             # at most n of them
    found = windows.withColumn("_w", F.transform("window", lambda w: F.xxhash64(w)))
    by_length = F.lit(None).cast("long")
    for k in lengths:
        by_length = F.when(F.col("n") == k, window_hash(F.col("_w"), F.lit(0), k)).otherwise(by_length)
    found = found.select(by_length.alias("_hash"), F.col("n").alias("_n"), "window", "items")
    sent = (size["bytes"] or 0) <= BROADCAST_BYTES

    id_ = [F.col(key).alias("_id")] if every else []
    d = docs.select(*[c.alias(k) for k, c in _row_key(docs, key, text).items()], *id_,
                    normal_words(text).alias("_words"))
    d = d.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    lengths = lengths or [n]                                     # nothing to look for: joins with nothing
    # explode_outer: the optimiser would push explode's own not-empty filter below the
    # projections and compute the hashes again for every window.
    if sent:
        # Probing takes place where the windows are made, so only hits are cut from the
        # words. Windows of one length after another: longer lengths come first.
        skipped = F.lit(0)
        for k in lengths:
            skipped = skipped + F.when(F.col("_n") < k, F.greatest(F.size("_words") - k + 1, F.lit(0))).otherwise(0)
        # With ``every`` a null stands before the hashes: it meets no window and is the row
        # of the document itself.
        own = [F.array(F.lit(None).cast("long"))] if every else []
        hits = (d.select(*d.columns[:-1], F.posexplode_outer(
                    F.concat(*own, *[window_hashes("_hashes", k) for k in lengths])).alias("_i", "hash"))
                .join(F.broadcast(found), F.col("hash") == F.col("_hash"), "left" if every else "inner")
                .withColumn("_at", F.col("_i") - skipped - len(own)))
        same = F.slice("_words", F.col("_at") + 1, F.col("_n")) == F.col("window")
        if every:
            hits = (hits.filter((F.col("_i") == 0) | (F.col("_hash").isNotNull() & same))
                    .withColumn("_size", F.when(F.col("_i") == 0, F.size("_words"))))
        else:
            hits = hits.filter(same)
    else:
        hits = (d.select(*ROW_KEY, F.explode_outer(
                    F.concat(*[windows_of("_words", "_hashes", k) for k in lengths])).alias("_w"))
                .select(*ROW_KEY, "_w.*").join(found, F.col("hash") == F.col("_hash"))
                .filter(F.col("words") == F.col("window")).withColumn("_at", F.col("at")))
        if every:
            hits = hits.unionByName(d.select(*ROW_KEY, "_id", F.size("_words").alias("_size")), allowMissingColumns=True)
    of_row = [F.max("_id").alias(key), F.max("_size").cast("long").alias("n_words"), F.count("_size").alias("copies")] if every else []
    span = F.when(F.col("_n").isNotNull(), F.struct(F.col("_at").alias("start"), (F.col("_at") + F.col("_n")).alias("end")))
    per_doc = hits.groupBy(*ROW_KEY).agg(
        F.sort_array(F.collect_set(span)).alias("_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), *of_row)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc: Column, x: Column) -> Column:
        tail = F.element_at(acc, -1)
        joined = F.struct(tail["start"].alias("start"), F.greatest(tail["end"], x["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]),
                      F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))
                      ).otherwise(F.concat(acc, F.array(x)))

    return (per_doc.withColumn("spans", F.aggregate("_spans", empty, merge)).drop("_spans")
            .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"),
                                             lambda a, x: a + x["end"] - x["start"])))


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = WINDOW, *, mode: str = "documents",
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every document with a hit (``mode="documents"``), or only the words inside
    hits with the separators after them (``mode="spans"``). Columns stay as they are."""
    marked = docs.select(*[c.alias(k) for k, c in _row_key(docs, key, text).items()],
                         F.struct(*docs.columns).alias("_row"))
    hits = contamination(docs, bench, n, key=key, text=text)
    if mode == "documents":
        return marked.join(hits, ROW_KEY, "left_anti").select("_row.*")
    if mode != "spans":
        raise ValueError(f"mode must be 'documents' or 'spans', got {mode!r}")
    whole = F.col("_row")[text]
    pieces = F.regexp_extract_all(whole, F.lit(f"{WORD}+{BREAK}*"), F.lit(0))
    head = F.regexp_extract(whole, f"^{BREAK}*", 0)
    kept = F.filter(pieces, lambda p, i: ~F.exists(
        "_spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    cleaned = F.when(F.col("_spans").isNull(), whole).otherwise(F.concat(head, F.array_join(kept, "")))
    joined = marked.join(hits.select(*ROW_KEY, F.col("spans").alias("_spans")), ROW_KEY, "left")
    return joined.select(F.col("_row").withField(text, cleaned).alias("_row")).select("_row.*")


# --- registered query -------------------------------------------------------------------


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = contamination(docs, read(spark, sf_dir, "benchmark"), every=True)
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = rf"""
with b as (
  select item_id::varchar as item, regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}') as w from benchmark),
bw as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select item, w, least(len(w), {WINDOW}) as n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as i
        from b where len(w) > 0)),
d as (
  select row_number() over () as r, doc_id, regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}') as w from documents),
dw as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw))),
hit as (select r, item, n, i from dw join bw using (n, s)),
n as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
it as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (r) left join it using (r)
"""

QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLE = {"op6_decontaminate": OP6_SQL}
