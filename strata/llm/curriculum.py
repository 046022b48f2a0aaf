"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target number of tokens and a weight schedule over training time
t in [0, 1]. A schedule is linear, w(t) = 1 - a + 2 a t with slope a in (-1, 1), so
its integral, the cumulative share of the target that is due at t, is
D(t) = t + a (t^2 - t). The documents of a source stand in a fixed shuffled order
(by MD5 of the key, or of the text where there is none); the order is gone through as often as the target needs, at most
``max_repeat`` times. A copy whose middle token is the u-th of its source is due at
the t with target * D(t) = u, which the quadratic formula gives. Sorting all copies by
t by range gives the training order.

No task holds a source: the shuffled order of a source is cut into buckets by the
leading hex digits of the MD5, prefix sums run inside buckets, and one small table of
bucket totals carries them on.

Defined results: a null source is a source of its own and sorts last; a null or empty
text has size 0 and is never asked for words; equal rows are separate documents with
adjacent places; an empty table gives an empty result; columns named like the outputs
are replaced.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import n_words, read
from strata.session import materialize

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)     # rising, even and falling demand, repeating like the weights
SHARE = 1.5
MAX_REPEAT = 2
BUCKET_ROWS = 512             # aimed at; at most 16**3 buckets a source
HEX_DIGITS = 3


def _cycle(values: Sequence[float], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (at % len(values)).cast("int"))


def source_targets(sizes: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """Targets of sources (``_null``, ``_src``, ``source_size``), one row a source.

    The targets share ``share`` times all sizes by weight; none goes above
    ``max_repeat`` times its source's size, and the excess is shared again by weight.
    That is a water level: with the sources in the order of cap per weight, the level
    is the largest (total - caps so far) / (weights left), and a target is the smaller
    of cap and weight times level. One row per source, so one small window.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy("_null", "_src")) - 1)
    ranked = ranked.withColumns({
        "_weight": _cycle([float(w) for w in weights], F.col("_rank")),
        "_cap": F.lit(float(max_repeat)) * F.col("source_size")})
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, left = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(left)
    return (ranked.withColumn("_level", level)
            .withColumn("target", F.least(F.col("_cap"), F.col("_weight") * F.max("_level").over(Window.partitionBy())))
            .drop("_cap", "_weight", "_level"))


def due(share: Column, slope: Column) -> Column:
    """The time t in [0, 1] at which the cumulative demand D(t) reaches ``share``."""
    rest = 1.0 - slope
    return 2.0 * share / (rest + F.sqrt(rest * rest + 4.0 * slope * share))


def plan_mix(df: DataFrame, *, source: str = "source", key: str = "doc_id", text: str = "text",
             weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES,
             share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and
    ``positions`` (training time of each copy taken)."""
    rows = df.count()
    digits = next((d for d in range(HEX_DIGITS) if 16 ** d * BUCKET_ROWS >= rows), HEX_DIGITS)
    # Rows without a key are told apart by their texts.
    place = F.md5(F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")))
    docs = df.drop("size", "source_size", "target", "copies", "taken", "positions").withColumns({
        "size": n_words(text),
        "_null": F.col(source).isNull(),
        "_src": F.coalesce(F.col(source).cast("string"), F.lit("")),
        "_place": place,
        "_bucket": F.substring(place, 1, digits) if digits else F.lit("")})
    of = ["_null", "_src"]
    buckets = docs.groupBy(*of, "_bucket").agg(F.sum("size").alias("_sum"))
    sources = source_targets(buckets.groupBy(*of).agg(F.sum("_sum").alias("source_size")),
                             weights=weights, share=share, max_repeat=max_repeat)
    before = Window.partitionBy(*of).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (buckets.withColumn("_head", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
             .drop("_sum").join(sources, of))
    inside = (Window.partitionBy(*of, "_bucket").orderBy("_place", key, "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = docs.join(heads, [*of, "_bucket"]).withColumn(
        "_start", F.col("_head") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    middles = F.array(*[F.col("_start") + j * F.col("source_size") + F.col("size") / 2
                        for j in range(max_repeat)])
    taken = F.filter(middles, lambda u: u < F.col("target"))
    slope = _cycle(slopes, F.col("_rank"))
    return (placed.withColumn("_taken", taken)
            .withColumns({"copies": F.size("_taken"),
                          "taken": (F.size("_taken") * F.col("size")).cast("long"),
                          "positions": F.transform("_taken", lambda u: due(u / F.col("target"), slope))})
            .drop(*of, "_place", "_bucket", "_head", "_rank", "_start", "_taken"))


def training_order(plan: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per copy taken, range-sorted by training time."""
    copies = plan.select("*", F.explode("positions").alias("position")).drop("positions")
    return copies.repartitionByRange("position", key).sortWithinPartitions("position", key)


# --- registered query -------------------------------------------------------------------


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix is read off the training order: words taken and places of the copies that
    stand in it."""
    plan = plan_mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    plan = materialize(plan.select("doc_id", "size", "source_size", "target", "positions",
                                   F.monotonically_increasing_id().alias("row")))
    order = training_order(plan.select("row", "size", "positions"), key="row")
    taken = order.groupBy("row").agg(F.sum("size").alias("taken"), F.min("position").alias("first"),
                                     F.max("position").alias("last"), F.count(F.lit(1)).alias("copies"))
    return plan.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.round("first", 9).alias("position"), F.when(F.col("copies") > 1, F.round("last", 9)).alias("second_position"))


OP10_SQL = """
with recursive d as (
  select doc_id, source, md5(coalesce(doc_id::varchar, text, '')) as place,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source asc nulls last) - 1 as k
  from d group by source),
w as (
  select *, 2.0::double * source_size as cap, ([5.0, 2.0, 1.0]::double[])[(k % 3) + 1] as weight,
         1.5::double * sum(source_size) over () as total
  from s),
-- share by weight; whatever is above its cap stops there, the rest is shared again
step as (
  select 0 as i, k, cap, weight, total, false as capped, 0.0::double as target from w
  union all
  select i + 1, k, cap, weight, total, capped or fair >= cap, case when capped or fair >= cap then cap else fair end
  from (select *, weight * (total - coalesce(sum(cap) filter (where capped) over (), 0.0))
                  / nullif(sum(weight) filter (where not capped) over (), 0.0) as fair
        from step where i <= (select count(*) from w))),
t as (select k, target from step where i = (select count(*) from w)),
p as (
  select doc_id, size, source_size, target, k,
         coalesce(sum(size) over (partition by k order by place, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) + size / 2.0::double as u
  from d join w on d.source is not distinct from w.source join t using (k)),
q as (select *, ([0.5, 0.0, -0.5]::double[])[(k % 3) + 1] as a,
             (u < target)::int + (u + source_size < target)::int as copies from p),
z as (select *, u / target as x, (u + source_size) / target as y from q)
select doc_id, size, source_size, target, (copies * size)::bigint as taken,
       case when copies > 0 then round(2.0::double * x / ((1.0::double - a)
         + sqrt((1.0::double - a) * (1.0::double - a) + 4.0::double * a * x)), 9) end as position,
       case when copies > 1 then round(2.0::double * y / ((1.0::double - a)
         + sqrt((1.0::double - a) * (1.0::double - a) + 4.0::double * a * y)), 9) end as second_position
from z
"""

QUERIES = {"op10_curriculum_mix": op10_curriculum_mix}
ORACLE = {"op10_curriculum_mix": OP10_SQL}
