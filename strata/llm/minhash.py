"""Near-duplicate detection with circulant MinHash.

A text's set is its distinct word shingles. Two permutations of the 32-bit universe
make the whole signature: one scatters the shingles, the other, shifted circularly by
k = 0, 1, 2, ..., is evaluated at the scattered shingles, and its smallest value is
coordinate k. Signatures are cut into bands; texts that share a band are candidates, and
a candidate pair is linked only if the exact Jaccard similarity of the full sets reaches
the threshold. Groups are the connected components of the links.

With ``BANDS`` bands of ``ROWS`` coordinates a pair at similarity 0.8 shares no band with
probability (1 - 0.8^6)^50, about 3 in 10 million.

Hot groups never become all pairs. Texts with equal sets are one vertex from the start;
vertices are sets, not keys, so a key with several texts has all of them compared, and
its sets are linked with each other.
In a bucket every member is compared with the bucket's hub, the member that meets most
others in its buckets, so a bucket of n gives n - 1 pairs, and most members of a group
join its component. Members that are still outside their hub's component meet the
others of such buckets by an exact filter instead of by bucket: with shingles ordered from rare to
common, two sets at the similarity share a shingle among the first few of both (the
prefixes), at places that leave enough shingles for the overlap, and their sizes are
near. What tells outsiders from their hub is rare in its group and stands in front, so an
outsider meets the few sets that share its rare shingles. No link is lost that
any shared band can show.

Defined results: a null or wordless text has an empty set and is linked with nothing; a
text of fewer words than a shingle has one shingle, all its words; a row without a key is
linked with nothing; rows with one key are one group at least; repeated rows stay as rows; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.arrowtext import Powers, as_bytes, byte_values, lower, mix, pieces, word_hashes
from strata.llm.common import read
from strata.llm.components import components
from strata.session import materialize

SHINGLE_WORDS = 5
SIMILARITY = 80               # per cent
BANDS, ROWS = 50, 6
CLASS_STEP = 1.03             # sizes in one class of the exact filter differ by this factor


def permute(x: np.ndarray, key: int) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = x ^ np.uint32(key)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int, values: np.ndarray, powers: Powers
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingles of every text, ascending, and the bounds of the sets."""
    h, w = word_hashes(raw, offsets, values, powers)
    out, bounds = [], np.zeros(len(offsets), np.int64)
    factors = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(k)]
    for d in range(len(offsets) - 1):
        own = h[w[d]:w[d + 1]]
        if len(own):
            m = min(k, len(own))
            n = len(own) - m + 1
            s = np.zeros(n, np.uint64)
            for i in range(m):
                s += mix(own[i:i + n]) * factors[i]
            own = np.unique(mix(s + np.uint64(m)))
            out.append(own)
        bounds[d + 1] = bounds[d] + len(own)
    return np.concatenate(out or [np.zeros(0, np.uint64)]), bounds


def signatures(sets: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash signatures (texts x size) of non-empty sets."""
    scattered = permute((sets >> np.uint64(32)).astype(np.uint32), 0x5BD1E995)
    out = np.empty((len(bounds) - 1, size), np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(permute(scattered + np.uint32(k), 0x2545F491), bounds[:-1])
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(signature), bands), np.uint64)
    cut = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    for r in range(rows):
        h = mix(h + cut[:, :, r] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return mix(h + np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        raw, off = as_bytes(b.column("text"))
        raw = lower(raw)
        for i, j in pieces(off):
            yield b, i, j, raw[off[i]:off[j]], off[i:j + 1] - off[i]


def sketch(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``key``, ``n`` (set size), ``class`` (digest of the set) and ``bands`` of all rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for b, i, j, raw, off in _texts(batches):
            sets, bounds = shingle_sets(raw, off, k, values, powers)
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            filled = np.append(bounds[some], bounds[-1])
            hashes = (band_hashes(signatures(sets, filled, bands * rows), bands, rows)
                      if len(some) else np.zeros((0, bands), np.uint64))
            width = np.where(n > 0, bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()), pa.array(hashes.ravel().view(np.int64)))
            digest = [hashlib.blake2b(sets[x:y].tobytes(), digest_size=16).digest()
                      for x, y in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("key").slice(i, j - i), pa.array(n), pa.array(digest, pa.binary()), lists],
                ["key", "n", "class", "bands"])

    return docs.mapInArrow(run, "key long, n long, class binary, bands array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """``key``, ``class`` and the whole ``set`` of all rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for b, i, j, raw, off in _texts(batches):
            sets, bounds = shingle_sets(raw, off, k, values, powers)
            digest = [hashlib.blake2b(sets[x:y].tobytes(), digest_size=16).digest()
                      for x, y in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("key").slice(i, j - i), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))],
                ["key", "class", "set"])

    return docs.mapInArrow(run, "key long, class binary, set array<long>")


def _near(n: str, m: str, similarity: int) -> Column:
    """Sizes that a pair at the similarity can have."""
    return 100 * F.least(n, m) >= similarity * F.greatest(n, m)


def _links(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those pairs (``u``, ``v``) whose full sets reach the similarity."""
    whole = lambda name, s: sets.select(F.col("id").alias(name), F.col("set").alias(s))      # noqa: E731
    both = pairs.join(whole("u", "a"), "u").join(whole("v", "b"), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.filter(100 * shared >= similarity * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _outside_pairs(members: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (``u``, ``v``) of ``members`` (id, n, root, out) that may reach the similarity, have
    different roots, and of which one is ``out`` at least: a superset of those that do.

    Shingles that only one member has come first in its order and match nothing, so only
    their number counts. A pair of sizes m <= n needs an overlap of at least
    similarity / (100 + similarity) * (m + n); the first common shingle, at places p and q,
    leaves at most min(m - p, n - q) of them.
    """
    of = ["id", "n", "root", "out"]
    shingles = members.join(sets.select("id", "set"), "id").select(*of, F.explode("set").alias("t"))
    common = shingles.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = (shingles.join(common, "t").groupBy(*of)
               .agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("s")))
    least = lambda n: F.expr(f"({similarity} * {n} + 99) div 100")                           # noqa: E731
    front = ordered.withColumn("far", F.size("s") - least("n") + 1).filter("far > 0")
    rows = materialize(front.select(*of, (F.col("n") - F.size("s")).alias("alone"), F.posexplode(F.slice("s", 1, F.col("far").cast("int"))))
                       .select(*of, (F.col("alone") + F.col("pos")).alias("p"), F.col("col.t").alias("t")))
    size_class = lambda n: F.floor(F.log(n) / F.log(F.lit(CLASS_STEP))).cast("int")          # noqa: E731
    # The smaller of a pair, or of one size the smaller vertex, stands in the index.
    half = F.expr(f"(2 * {similarity} * n + {99 + similarity}) div {100 + similarity}")
    index = rows.filter(F.col("p") <= F.col("n") - half).select(
        *[F.col(c).alias(f"i_{c}") for c in (*of, "p")], "t", size_class(F.col("n")).alias("c"))
    most = F.expr(f"({100 + similarity} * (n - p)) div {similarity} - n")
    probe = (rows.withColumn("most", F.least("n", most)).filter(F.col("most") >= least("n"))
             .withColumn("c", F.explode(F.sequence(size_class(least("n")), size_class(F.col("most"))))))
    left = F.least(F.col("i_n") - F.col("i_p"), F.col("n") - F.col("p"))
    met = ((F.col("i_root") != F.col("root")) & (F.struct("i_n", "i_id") < F.struct("n", "id"))
           & ((100 + similarity) * left >= similarity * (F.col("i_n") + F.col("n"))))
    pairs = [i.join(q, ["t", "c"]).filter(met).select(F.least("i_id", "id").alias("u"), F.greatest("i_id", "id").alias("v"))
             for i, q in ((index.filter("i_out"), probe), (index.filter("not i_out"), probe.filter("out")))]
    return pairs[0].unionByName(pairs[1]).distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    k: int = SHINGLE_WORDS, similarity: int = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n`` (set size), ``root`` (the smallest key of
    its group, its own if it is in none)."""
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    sketched = materialize(sketch(docs, k, bands, rows))
    linkable = sketched.filter((F.col("n") > 0) & F.col("key").isNotNull())
    # Equal sets are one vertex, numbered; the class keeps its smallest key.
    classes = materialize(linkable.groupBy("class").agg(F.min(F.struct("key", "n", "bands")).alias("c"))
                          .select(F.monotonically_increasing_id().alias("id"), "class", "c.*"))
    several = (linkable.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
               .filter("low < high").select("key"))
    several = materialize(linkable.join(several, "key").select("key", "class").distinct()
                          .join(classes.select("class", "id"), "class").select("key", "id"))
    own = several.join(several.groupBy("key").agg(F.min("id").alias("u")), "key").select("u", F.col("id").alias("v"))

    members = classes.select(F.explode("bands").alias("bucket"), F.col("id").alias("v"), "n")
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(members.join(full, "bucket"))
    degrees = members.groupBy("v").agg(F.sum("size").alias("degree"))
    hubs = members.join(degrees, "v").groupBy("bucket").agg(F.max(F.struct("degree", "v", "n")).alias("hub"))
    members = materialize(members.join(hubs, "bucket").select("bucket", "v", "n", F.col("hub.v").alias("hub"), F.col("hub.n").alias("m")))
    vertices = classes.join(members.select(F.col("v").alias("id")).distinct(), "id").select("id", "key", "class")
    texts = docs.join(vertices.select("key").distinct(), "key").select("key", "text")
    sets = materialize(full_sets(texts, k).join(vertices, ["key", "class"]).dropDuplicates(["id"]).select("id", "set"))

    pairs = (members.filter((F.col("v") != F.col("hub")) & _near("n", "m", similarity))
             .select(F.least("v", "hub").alias("u"), F.greatest("v", "hub").alias("v")).distinct())
    links = materialize(own.filter("u < v").unionByName(_links(pairs, sets, similarity)))
    roots = components(links)
    placed = members.join(roots, "v", "left").select("bucket", "v", "n", "hub", F.coalesce("root", "v").alias("root"))
    # Buckets with members beyond their hub's component; in a bucket of two all is decided.
    open_ = (placed.groupBy("bucket").agg(F.max(F.when(F.col("v") == F.col("hub"), F.col("root"))).alias("hub_root"),
                                          F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
             .filter("low < high and size > 2").select("bucket", "hub_root"))
    unsettled = materialize(placed.join(open_, "bucket").groupBy(F.col("v").alias("id"), "n", "root")
                            .agg(F.max(F.col("root") != F.col("hub_root")).alias("out")))
    links = links.unionByName(_links(_outside_pairs(unsettled, sets, similarity), sets, similarity))
    roots = components(links)
    # A component is named by the smallest key of its classes.
    grouped = classes.select("id", "class", "key").join(roots.withColumnRenamed("v", "id"), "id", "left").select(
        "class", "key", F.coalesce("root", "id").alias("component"))
    names = grouped.groupBy("component").agg(F.min("key").alias("root"))
    named = grouped.join(names, "component").select("class", "root")
    moved = linkable.select("key", "class").join(named, "class").filter("key != root").select("key", "root").distinct()
    return sketched.select("key", "n").join(moved, "key", "left").select(
        "key", "n", F.coalesce("root", "key").alias("root"))


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of every group, the one of the smallest key. A document
    repeated with the same key and text stays once; rows without a key all stay."""
    groups = near_duplicates(docs, key=key, text=text, **options)
    gone = groups.filter(F.col("key") != F.col("root")).select(F.col("key").alias(key)).distinct()
    keyed = docs.filter(F.col(key).isNotNull()).join(gone, key, "left_anti").dropDuplicates([key, text])
    return keyed.select(*docs.columns).unionByName(docs.filter(F.col(key).isNull()))


# --- registered query -------------------------------------------------------------------


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read(spark, sf_dir, "documents"), k=2)
    return groups.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
                         F.col("root").alias("component_id"), F.col("key").eqNullSafe(F.col("root")).alias("kept"))


QUERIES = {"op7_circulant_minhash": op7_circulant_minhash}
ORACLE: dict[str, str] = {}
