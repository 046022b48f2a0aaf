"""Whitening of embeddings by their principal components.

Vectors become whole numbers, x = floor(64 c) + 1,000,000. Identical x vectors are one
row with their number of copies, and only those distinct vectors are worked on: their sums
give the mean, a centred matrix product in every task gives the covariance, each distinct
vector is whitened once, and the result is joined back to the rows. The fit counts a
distinct vector once or as often as it occurs (``weights``).

Products are taken after subtracting the whole number next to the mean, so every partial
sum is a whole number: exact in doubles below 2 ** 53, whatever the order of addition. The
rest of the mean, below one half, is taken off the summed matrix. What reaches the driver
is bounded by the dimension: a mean and a matrix.

Defined results: a vector that is null or holds a null, NaN or infinite entry is dropped;
vectors shorter than the longest have zeros there; entries beyond 2 ** 52 / 64 count as
that; equal vectors get equal results and every row its own; rows without an id stay; a
component without variance has ``whitened`` null; ``deviation`` is null where the exact
number needs more than 63 bits; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read
from strata.session import materialize

SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 52)
COMPONENTS = 16
FLAT = 1e-12                  # eigenvalues up to this share of the trace are no variance


def whole_vectors(df: DataFrame, vector: str = "embedding", name: str = "x") -> DataFrame:
    """``df`` without bad vectors, and with the whole-numbered ones as array<long>."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    x = F.transform(v, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT)
    rows = df.filter(v.isNotNull()).filter(~bad).withColumn(name, x)
    sizes = rows.agg(F.min(F.size(name)).alias("least"), F.max(F.size(name)).alias("most")).first()
    if sizes["least"] == sizes["most"]:
        return rows
    pad = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(sizes["most"]) - F.size(name))
    return rows.withColumn(name, F.concat(name, pad))


def _matrix(column: pa.Array, n: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(n, -1)


@dataclass(frozen=True)
class Mean:
    """A mean of whole-numbered vectors: ``near`` + ``rest`` / n, with |rest| <= n / 2."""
    n: int
    near: np.ndarray
    rest: np.ndarray


def mean_of(distinct: DataFrame, column: str = "x", weight: str = "weight") -> Mean | None:
    """Exact weighted mean of whole-numbered vectors; None without any."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, w = _matrix(b.column(column), b.num_rows, np.int64), b.column(weight).to_numpy()
            # In two halves, which cannot overflow.
            high, low = (w[:, None] * (x >> 32)).sum(0), (w[:, None] * (x & 0xFFFFFFFF)).sum(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(high)), pa.int32()), pa.array(high), pa.array(low), pa.array(np.full(len(high), w.sum()))],
                ["i", "high", "low", "n"])

    whole = "decimal(38,0)"
    sums = (distinct.select(column, weight).mapInArrow(run, "i int, high long, low long, n long")
            .groupBy("i").agg(*[F.sum(F.col(c).cast(whole)).alias(c) for c in ("high", "low", "n")]).orderBy("i").collect())
    if not sums:
        return None
    n = int(sums[0]["n"])
    total = [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    near = [(2 * s + n) // (2 * n) for s in total]
    return Mean(n, np.array(near, np.int64), np.array([s - n * p for s, p in zip(total, near)], object))


def products(frame: DataFrame, column: str, centre: np.ndarray, weight: str | None = None) -> np.ndarray:
    """Sum over rows of weight * d d^T with d = vector - centre: a matrix product per task,
    the partial matrices added up by Spark."""
    size = len(centre)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                d = (_matrix(b.column(column), b.num_rows, centre.dtype) - centre).astype(np.float64)
                w = d if weight is None else d * b.column(weight).to_numpy()[:, None]
                total += w.T @ d
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "p"])

    out = np.zeros((size, size))
    columns = [column] if weight is None else [column, weight]
    for r in (frame.select(*columns).mapInArrow(run, "i int, j int, p double")
              .groupBy("i", "j").agg(F.sum("p").alias("p")).collect()):
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"]
    return out


@dataclass(frozen=True)
class Whitener:
    mean: Mean
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # unit eigenvectors, one a column
    trace: float

    @property
    def live(self) -> np.ndarray:
        return (self.values > FLAT * self.trace) & (self.values > 0)

    @property
    def projection(self) -> np.ndarray:
        return np.where(self.live, self.vectors / np.sqrt(np.where(self.live, self.values, 1.0)), 0.0)


def fit(distinct: DataFrame, *, components: int = COMPONENTS, column: str = "x", weight: str = "weight") -> Whitener | None:
    """Mean, eigenvalues and eigenvectors of the weighted covariance (divisor n)."""
    mean = mean_of(distinct, column, weight)
    if mean is None:
        return None
    rest = np.array([int(r) / mean.n for r in mean.rest], np.float64)
    cov = products(distinct, column, mean.near, weight) / mean.n - np.outer(rest, rest)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Whitener(mean, values, vectors * np.where(sign == 0, 1, sign), float(np.trace(cov)))


def whiten(distinct: DataFrame, model: Whitener, column: str = "x") -> DataFrame:
    """``distinct`` with ``deviation`` (sum of (n x - S)^2) and ``whitened`` (array<double>)."""
    n, near, rest, projection = model.mean.n, model.mean.near, model.mean.rest, model.projection
    offset = np.array([int(r) / n for r in rest], np.float64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = _matrix(b.column(column), b.num_rows, np.int64) - near
            d = a.astype(np.float64) - offset
            w = d @ projection
            size = float(n) * float(n) * (d * d).sum(1)
            fits = (size < 2.0 ** 62) & (np.abs(a).max(1, initial=0) < 2.0 ** 62 / n)
            exact = np.zeros(len(a), np.int64)
            exact[fits] = ((n * a[fits] - rest.astype(np.int64)) ** 2).sum(1) if fits.any() else 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(exact, mask=~fits), lists], [*b.schema.names, "deviation", "whitened"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in distinct.schema)
    return distinct.mapInArrow(run, f"{schema}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitener, weight: str = "weight") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over
    the components that have variance."""
    live = np.flatnonzero(model.live)
    if not len(live):
        return None
    means = whitened.agg(*[(F.sum(F.get("whitened", F.lit(int(k))) * F.col(weight)) / model.mean.n).alias(f"m{k}")
                           for k in range(len(model.values))]).first()
    cov = products(whitened, "whitened", np.array(means, np.float64), weight) / model.mean.n
    return float(np.abs(cov[np.ix_(live, live)] - np.eye(len(live))).max())


def whitened_rows(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
                  weights: str = "one") -> DataFrame:
    """One row per good row of ``df``: ``key``, ``x``, ``n``, ``copies``, ``deviation``, the
    whole ``whitened`` vector, ``explained`` shares (array) and ``identity_error``."""
    rows = whole_vectors(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector").select("key", "x")
    distinct = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = materialize(distinct.withColumn("weight", F.col("copies") if weights == "count" else F.lit(1).cast("long")))
    model = fit(distinct, components=components)
    if model is None:
        return rows.selectExpr(f"key as {key}", "x", "0L as n", "0L as copies", "0L as deviation",
                               "cast(null as array<double>) as whitened", "cast(null as array<double>) as explained",
                               "cast(null as double) as identity_error")
    whitened = materialize(whiten(distinct, model))
    error = identity_error(whitened, model)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))
    live = F.array(*[F.lit(bool(k)) for k in model.live])
    return (rows.join(whitened, "x").select(
        F.col("key").alias(key), "x", F.lit(model.mean.n).cast("long").alias("n"), "copies", "deviation",
        F.zip_with("whitened", live, lambda w, k: F.when(k, w)).alias("whitened"),
        F.array(*[F.lit(float(v)) for v in explained]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error")))


# --- registered query -------------------------------------------------------------------


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitened_rows(read(spark, sf_dir, "embeddings"))
    per = F.posexplode(F.arrays_zip("whitened", "explained"))
    return (rows.select("vec_id", "n", "deviation", "identity_error", per.alias("at", "c"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                    F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
ORACLE: dict[str, str] = {}
