"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for credentials. The hash of each candidate's value is counted
over the whole corpus: in how many repositories and for how many owners does it occur?
A value that many owners share is an example that was copied around; one that only one
or two owners have, and that looks random, is taken for a live credential and gets a
``live`` span of its own.

The scan keeps no texts and no values, only spans and value hashes. Ownership is one
distinct count per hash, pre-aggregated before its shuffle; verdicts return to the
documents by joins on the hash and the row.

Defined results: a null text counts as empty; a null owner or repository is one of its
own; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read
from strata.session import materialize

MIN_OWNERS = 3                # from so many owners on, a value is a copied example
MIN_ENTROPY = 2.5             # bits a character that a live-looking value has at least

# Base kinds in their order, then the kinds added to them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")                 # AKIA[A-Z0-9]+ of 20 or more
HEX = re.compile(r"[0-9a-f]{24,}")
ADDED = {
    "private_key": re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}
HINTS = {"private_key": "PRIVATE KEY", "github": "gh", "jwt": "eyJ"}
KINDS = ["assign", "access", "hex", *ADDED, "live"]
ASSIGN_HINTS = ("passw", "secret", "token", "api")

SPAN = "struct<start:int,rank:int,end:int>"
FOUND = (f"row long, doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
         f"found array<{SPAN}>, candidates array<struct<hash:string,start:int,end:int>>")


def entropy(value: str) -> float:
    """Bits per character of the value's own character frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def find(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind's rank, end, value's start, value's end) of all matches, sorted."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    for rank, (kind, pattern) in enumerate(ADDED.items(), 3):
        if HINTS[kind] in text:
            out += [(m.start(), rank, m.end(), m.start(), m.end()) for m in pattern.finditer(text)]
    return sorted(out)


def scan_text(text: str) -> tuple[list[tuple], list[dict]]:
    """All matches, and the live-looking values: hash and span (a value found by two
    kinds is one)."""
    matches = find(text)
    values = {}
    for _, rank, _, i, j in matches:
        if KINDS[rank] != "private_key" and entropy(text[i:j]) >= MIN_ENTROPY:
            values[i, j] = hashlib.blake2b(text[i:j].encode(), digest_size=16).hexdigest()
    return matches, [{"hash": h, "start": i, "end": j} for (i, j), h in sorted(values.items())]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
    value = pa.list_(pa.struct([("hash", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    none = hashlib.sha256(b"").hexdigest()
    for b in batches:
        n = [[], [], []]
        digests, found, candidates = [], [], []
        for text in b.column("text"):
            matches, values = scan_text(text.as_py() or "")
            base = [m for m in matches if m[1] < 3]
            for rank in range(3):
                n[rank].append(sum(m[1] == rank for m in base))
            digests.append(none if not base else hashlib.sha256(
                ",".join(f"{KINDS[r]}:{i}:{j}" for i, r, j, *_ in base).encode()).hexdigest())
            found.append([{"start": i, "rank": r, "end": j} for i, r, j, *_ in matches])
            candidates.append(values)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("doc_id"), *[pa.array(x, pa.int64()) for x in n], pa.array(digests),
             pa.array(found, span), pa.array(candidates, value)],
            ["row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "found", "candidates"])


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every ``hash``."""
    held = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("_"))
    return held.groupBy("hash").agg(F.countDistinct("owner").alias("owners"),
                                    F.countDistinct("repository").alias("repositories"))


def scan_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", owner: str = "source",
                 repository: str = "repository", min_owners: int = MIN_OWNERS) -> DataFrame:
    """Per row: counts and digest of the base spans, ``found`` spans, and ``live`` and
    ``examples``, the candidate values split by ownership, each with its distinct owners and
    repositories."""
    nonnull = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                       F.col(text).alias("text"), nonnull(owner).alias("owner"),
                       nonnull(repository).alias("repository"))
    scanned = materialize(_with_owner(rows))
    candidates = scanned.select("row", "owner", "repository", F.explode("candidates").alias("c")).select(
        "row", "owner", "repository", "c.*")
    verdicts = ownership(candidates).withColumn("copied", F.col("owners") >= min_owners)
    span = F.struct("start", "end", "owners", "repositories")
    split = (candidates.join(verdicts, "hash").groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(~F.col("copied"), span))).alias("live"),
        F.sort_array(F.collect_list(F.when(F.col("copied"), span))).alias("examples")))
    return scanned.drop("candidates").join(split, "row", "left")


def _with_owner(rows: DataFrame) -> DataFrame:
    """The scan, with the owner columns carried beside it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for out in _scan([b]):
                yield pa.RecordBatch.from_arrays([*out.columns, b.column("owner"), b.column("repository")],
                                                 [*out.schema.names, "owner", "repository"])

    return rows.mapInArrow(run, FOUND + ", owner string, repository string")


# --- registered query -------------------------------------------------------------------


def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository"))
    out = scan_secrets(docs)
    none = F.array().cast("array<struct<start:int,end:int,owners:bigint,repositories:bigint>>")
    live, examples = F.coalesce("live", none), F.coalesce("examples", none)
    spans = F.sort_array(F.concat("found", F.transform(live, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index("live")).alias("rank"), s["end"].alias("end")))))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        F.size(live).cast("long").alias("n_live"), F.size(examples).cast("long").alias("n_examples"),
        F.array_join(F.transform(F.sort_array(F.concat(live, examples)), lambda s: F.concat_ws(
            ":", *[s[c].cast("string") for c in ("start", "end", "owners", "repositories")])), ",").alias("ownership"))


QUERIES = {"op5_secret_ownership": op5_secret_ownership}
ORACLE: dict[str, str] = {}
