"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised into 2^bits cells each, the cells are put
in the order of a Hilbert curve (cells that are neighbours on the curve are
neighbours in every dimension), rows are range-sorted by curve index, and the sorted
sequence is cut into equal runs. A run then covers a compact box of the metadata
space, so min/max statistics per shard prune files for filters on any dimension.

Everything is DataFrame functions. Cells are equi-depth, so a value that holds a third of
all rows takes one cell and the other cells share the rest. Cut points are
exact order statistics, of numbers and of whole strings alike: counts per value are
range-sorted and summed up. Global positions come from a range sort
plus one row count per sorted partition; no task sees more than its own range.

Defined results: a null dimension sorts lowest (cell 0); equal rows take adjacent
slots; an empty table gives an empty result; columns named like the outputs are
replaced by the outputs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, read, text_or_empty, utf8_bytes
from strata.session import materialize


def hilbert_steps(n: int) -> tuple[list[int], list[int]]:
    """Digit and next-state tables of the n-dimensional Hilbert curve.

    A state is (entry corner e, axis d), numbered ``e * n + d``; at state s the
    subcube whose per-dimension bits are l has digit ``digit[s * 2**n + l]`` and
    continues in ``step[s * 2**n + l]``. Built from the reflected Gray code.
    """
    size = 1 << n

    def rotate(x: int, k: int) -> int:
        k %= n
        return ((x << k) | (x >> (n - k))) & (size - 1) if k else x

    rank = {g ^ (g >> 1): g for g in range(size)}            # inverse Gray code

    def entry(w: int) -> int:
        even = 2 * ((w - 1) // 2) if w else 0
        return even ^ (even >> 1)

    def axis(w: int) -> int:
        if w == 0:
            return 0
        odd = w - 1 if w % 2 == 0 else w
        return ((~odd & (odd + 1)).bit_length() - 1) % n       # trailing one bits

    digit, step = [0] * (size * n * size), [0] * (size * n * size)
    for e in range(size):
        for d in range(n):
            for label in range(size):
                w = rank[rotate(label ^ e, n - (d + 1) % n)]
                at = (e * n + d) * size + label
                digit[at] = w
                step[at] = (e ^ rotate(entry(w), d + 1)) * n + (d + axis(w) + 1) % n
    return digit, step


def curve_index(cells: Sequence[Column], bits: int) -> Column:
    """Hilbert index of integer cells in ``[0, 2**bits)``, as a native fold over bit levels."""
    n = len(cells)
    digit, step = hilbert_steps(n)
    digits, steps = (F.array(*[F.lit(v) for v in t]) for t in (digit, step))
    levels = F.array(*[
        sum((F.shiftright(c, i).bitwiseAND(F.lit(1)) * F.lit(1 << j) for j, c in enumerate(cells)),
            F.lit(0))
        for i in reversed(range(bits))])

    def descend(acc: Column, label: Column) -> Column:
        at = acc["state"] * F.lit(1 << n) + label
        return F.struct(F.get(steps, at).alias("state"),
                        (acc["index"] * F.lit(1 << n) + F.get(digits, at)).alias("index"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(levels, start, descend, lambda acc: acc["index"])


def exact_cuts(df: DataFrame, dims: Sequence[str], cells: int, kind: str) -> list[list]:
    """Per dimension the values at ranks ceil(n * i / cells), 0 < i < cells, of its n values,
    compared as ``kind`` (double or string).

    Counts per value are range-sorted; a value's rank is the sum of its partition's counts up
    to it and of all earlier partitions. At most cells - 1 values of a dimension are collected.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.col(c).cast(kind).alias("v"))
                               for i, c in enumerate(dims)]))
    counts = materialize(df.select(each.alias("x")).select("x.*").filter("v is not null")
                         .groupBy("d", "v").agg(F.count(F.lit(1)).alias("n")))
    placed = materialize(counts.repartitionByRange("d", "v").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (placed.groupBy("d", "part").agg(F.sum("n").alias("s"))
            .select("d", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("off"),
                    F.sum("s").over(Window.partitionBy("d")).alias("total")))
    inside = Window.partitionBy("d", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("off") + F.col("upto")
    rank = F.expr(f"(total * i + {cells - 1}) div {cells}")
    found = (placed.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(runs), ["d", "part"])
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(cells - 1))))
             .filter((rank <= last) & (rank > last - F.col("n"))).select("d", "i", "v").collect())
    cuts: list[list] = [[] for _ in dims]
    for row in sorted(found):
        cuts[row["d"]].append(row["v"])
    return cuts


def quantise(df: DataFrame, dims: Sequence[str], bits: int) -> list[Column]:
    """Equi-depth cells in ``[0, 2**bits)`` per dimension; null falls in cell 0."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    number = [d for d in dims if isinstance(kinds[d], (T.NumericType, T.BooleanType))]
    text = [d for d in dims if d not in number]
    cuts: dict[str, list] = {}
    for kind, own in (("double", number), ("string", text)):
        if own:
            cuts |= dict(zip(own, exact_cuts(df, own, 1 << bits, kind)))
    cells = []
    for d in dims:
        k = F.col(d).cast("double" if d in number else "string")
        cells.append(sum([F.when(k > F.lit(c), 1).otherwise(0) for c in cuts[d]], F.lit(0)))
    return cells


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int, *, bits: int = 4,
                   ties: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``curve`` (Hilbert index), ``shard`` in [0, shards) and ``slot``.

    Shards are consecutive runs of the order (curve, ties); their row counts differ
    by at most one, and slots count gaplessly from 0 inside each shard.
    """
    df = df.drop("curve", "shard", "slot")
    part, at, off, total, n = (free_name(df, x) for x in ("_part", "_at", "_off", "_total", "_n"))
    keyed = df.withColumn("curve", curve_index(quantise(df, dims, bits), bits))
    order = [F.col("curve"), *[F.col(c) for c in ties]]
    placed = materialize(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({part: F.spark_partition_id(),
                      at: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    # One row per sorted partition: bounded by the number of shuffle partitions.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = (placed.groupBy(part).agg(F.count(F.lit(1)).alias(n))
            .select(F.col(part), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off),
                    F.sum(n).over(Window.partitionBy()).alias(total)))
    g, N = f"(`{off}` + `{at}`)", f"`{total}`"
    return (placed.join(F.broadcast(runs), part)
            .withColumn("shard", F.expr(f"cast({g} * {shards} div {N} as int)"))
            .withColumn("slot", F.expr(f"{g} - (shard * {N} + {shards - 1}) div {shards}"))
            .drop(part, at, off, total))


def shard_manifest(sharded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows and min/max of every dimension per shard: what a reader prunes files with."""
    stats = [f(d).alias(f"{k}_{d}") for d in dims for k, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *stats)


# --- registered query -------------------------------------------------------------------

SHARDS = 40
DIMS = ("lang", "source", "n_chars")
BITS = 4


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", *DIMS, (utf8_bytes("text") + 16).alias("size"),
        F.crc32(text_or_empty("text")).alias("text_crc32"))
    out = hilbert_shards(docs, DIMS, SHARDS, bits=BITS, ties=["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


def op1_sql() -> str:
    """The same by ranks and folds: cut points are order statistics, positions row numbers."""
    digit, step = hilbert_steps(len(DIMS))
    cells = 1 << BITS
    cuts = ", ".join(f"list_sort(list({d}) filter ({d} is not null)) as v{i}" for i, d in enumerate(DIMS))
    cell = ", ".join(
        f"case when {d} is null then 0 else len(list_filter(range(1, {cells}), "
        f"lambda i: v{i}[ceil(len(v{i}) * i / {cells}.0)::int] < {d})) end as c{i}" for i, d in enumerate(DIMS))
    labels = ", ".join("(" + " + ".join(f"((c{j} >> {i}) & 1) * {1 << j}" for j in range(len(DIMS))) + ")::bigint"
                       for i in reversed(range(BITS)))
    n = len(DIMS)
    return f"""
with t as (select {_crc_table()}::bigint[] as crc, {digit}::bigint[] as digit, {step}::bigint[] as step),
v as (select {cuts} from documents),
d as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 16 as size, {cell},
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::bigint)),
             lambda a, x: xor(a >> 8, t.crc[(xor(a, x) & 255) + 1])), 4294967295::bigint) as text_crc32
  from documents, v, t),
h as (
  select d.*, list_reduce(list_prepend(0::bigint, [{labels}]), lambda a, x:
      (((a >> 16) * {1 << n} + t.digit[(a & 65535) * {1 << n} + x + 1]) << 16)
      + t.step[(a & 65535) * {1 << n} + x + 1]) >> 16 as curve
  from d, t),
p as (
  select *, row_number() over (order by curve, doc_id nulls first, text_crc32, size) - 1 as g, count(*) over () as n from h)
select doc_id, size, text_crc32, 'rows' as law, (g * {SHARDS} // n)::int as shard,
       g - ((g * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} as slot, null::int as grown_shard, curve
from p
"""


QUERIES = {"op1_hilbert_shards": op1_hilbert_shards}
ORACLE = {"op1_hilbert_shards": op1_sql()}
