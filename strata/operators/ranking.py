"""Ranking, lag and top-N within groups, in forms that survive skewed groups.

``Window.partitionBy(g)`` sorts a whole group in one task, so a group holding a
third of the rows becomes one giant task. The operators here keep the exact
window semantics while bounding the work per task:

* ``rank_by_histogram``: when the order column has few distinct values per group,
  rank the (group, value) histogram and join it back.
* ``lag_within`` with ``blocks``: split each group into ordered blocks, lag inside
  blocks, and carry each block's last value into the next block.
* ``rank_by_range`` and ``lag_by_range``: only groups above a size are range-sorted by
  (group, order) and cut inside the sorted ranges, whatever their values; ranks and last
  values are carried from slice to slice.
* ``top_n``: ``rank() <= n`` is planned as a partial ``WindowGroupLimit`` before
  the shuffle, so only candidates are exchanged.
"""

from __future__ import annotations

import math
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import materialize


def _sort(c: str, descending: bool) -> Column:
    return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()


def rank_within(df: DataFrame, by: Sequence[str], order: str, *, descending: bool = True,
                name: str = "rank", tie_break: Sequence[str] = ()) -> DataFrame:
    """Plain window ``rank()``; fine when groups are small or numerous."""
    w = Window.partitionBy(*by).orderBy(_sort(order, descending),
                                        *[F.col(c).asc_nulls_first() for c in tie_break])
    return df.withColumn(name, F.rank().over(w).cast("bigint"))


def rank_by_histogram(df: DataFrame, by: Sequence[str], order: str, *, descending: bool = True,
                      name: str = "rank", max_rank: Optional[int] = None) -> DataFrame:
    """Exact ``rank()`` over ``partitionBy(by).orderBy(order)`` without sorting groups.

    rank = 1 + number of rows of the group that sort strictly before the row. The
    (by, order) histogram is aggregated map-side, ranked with a small window, and
    joined back on (by, order) null-safely. Ranks are longs: a group may have more
    than 2^31 rows.

    The histogram is written as Parquet once, so its bytes are known when the join is
    planned: Catalyst broadcasts it below ``autoBroadcastJoinThreshold`` and shuffles
    above (AQE splits skewed keys). Pass a written ``df``, so that the input itself is
    not recomputed for it. Building the result therefore runs a job.

    ``max_rank`` keeps only rows ranked at most that (top-N with ties): the
    histogram is cut first, so the join is a map-side filter and any number of
    tied rows in one group never meet in one task.
    """
    keys = list(by) + [order]
    hist = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*by).orderBy(_sort(order, descending))
              .rowsBetween(Window.unboundedPreceding, -1))
    hist = hist.select(*[F.col(k).alias(f"_h_{k}") for k in keys],
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias(name))
    if max_rank is not None:
        hist = hist.filter(F.col(name) <= max_rank)
    hist = materialize(hist)
    cond = [df[k].eqNullSafe(hist[f"_h_{k}"]) for k in keys]
    return df.join(hist, cond, "inner").drop(*[f"_h_{k}" for k in keys])


def large_groups(df: DataFrame, by: Sequence[str], max_rows: int) -> DataFrame:
    """The ``by`` keys of groups with more than ``max_rows`` rows, checkpointed.

    There are at most ``rows(df) / max_rows`` of them, so the result is small by
    construction (one map-side-combined aggregate computes it).
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return materialize(sizes.filter(F.col("_n") > max_rows).select(*by))


def lag_within(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, *,
               blocks: Optional[Sequence[Column]] = None,
               max_group_rows: Optional[int] = None) -> DataFrame:
    """``lag(value, 1)`` over ``partitionBy(by).orderBy(order)`` (ascending, nulls first).

    ``order`` must be a total order within a group for a deterministic result.
    ``blocks`` are expressions that never decrease along ``order`` inside a group
    (for example the year and a prefix of a hash key). Each (group, block) is then
    sorted on its own, and the last value of each block is carried into the next
    block of the same group through a small per-block summary, so no task ever
    holds a whole group.

    With ``max_group_rows`` only groups larger than that are split into blocks;
    the others stay one block each (so blocks are not created where no task is at
    risk), and when no group is that large the plain window is used. The large
    groups' keys (at most rows / ``max_group_rows`` of them) are written as Parquet, and
    the join with them is left to Catalyst, which knows their bytes. Finding them is a
    job: pass a written ``df``.
    """
    order_cols = [F.col(c).asc_nulls_first() for c in order]
    big = None
    if blocks and max_group_rows is not None:
        # A frame of no more rows than that has no such group; the count of a written one
        # comes from its footers.
        if df.count() <= max_group_rows:
            blocks = None
        else:
            big = large_groups(df, by, max_group_rows)
            if big.isEmpty():
                blocks = None
    if not blocks:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(*order_cols)))

    bnames = [f"_blk{i}" for i in range(len(blocks))]
    if big is None:
        x = df.withColumns(dict(zip(bnames, blocks)))
    else:
        marks = big.select(*[F.col(c).alias(f"_big_{c}") for c in by], F.lit(True).alias("_big"))
        cond = [df[c].eqNullSafe(marks[f"_big_{c}"]) for c in by]
        x = (df.join(marks, cond, "left").drop(*[f"_big_{c}" for c in by])
               .withColumns({b: F.when(F.col("_big"), e) for b, e in zip(bnames, blocks)})
               .drop("_big"))
    last = x.groupBy(*by, *bnames).agg(F.max_by(F.col(value), F.struct(*order)).alias("_last"))
    prev_block = Window.partitionBy(*by).orderBy(*[F.col(b).asc_nulls_first() for b in bnames])
    carry = last.select(*by, *bnames, F.lag("_last").over(prev_block).alias("_v"),
                        F.lit(1).alias("_carry"))
    rows = x.withColumns({"_v": F.col(value), "_carry": F.lit(0)})
    u = rows.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*by, *bnames).orderBy(F.col("_carry").desc(), *order_cols)
    return (u.withColumn(name, F.lag("_v").over(w))
             .filter(F.col("_carry") == 0)
             .drop("_v", "_carry", *bnames))


SLICE_ROWS = 1_000_000


def range_tasks(spark: SparkSession, rows: int, cut_rows: int) -> int:
    """Tasks of a range sort whose ranges are cut every ``cut_rows`` rows afterwards: no more
    than cuts, and beyond the shuffle partitions one for every ``SLICE_ROWS`` rows."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(math.ceil(rows / max(1, cut_rows)), max(usual, math.ceil(rows / SLICE_ROWS))))


def range_slices(df: DataFrame, by: Sequence[str], sorts: Sequence[Column], max_group_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``_slice``: 0 in groups of at most ``max_group_rows`` rows; larger ones are
    range-sorted by the group and ``sorts`` together and cut into slices of at most that many
    rows, numbered in order (from 1, with gaps). Rows equal in all of ``sorts`` may be cut.

    The ranges are those of the data, so no key prefix or time unit has to be guessed. Only
    the rows of large groups take part in the range sort, and they are written, because cuts
    depend on a sample and must be drawn once. A task cuts all slices of its range, so neither
    the tasks nor the sample that the driver sees grow with the number of slices. Pass a
    written ``df``.
    """
    if df.count() <= max_group_rows:
        return df.withColumn("_slice", F.lit(0).cast("long"))
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_group_rows)
    big = materialize(sizes.select(*[F.col(c).alias(f"_big_{c}") for c in by], "_n"))
    total = big.agg(F.sum("_n")).first()[0]
    if not total:
        return df.withColumn("_slice", F.lit(0).cast("long"))
    cond = [df[c].eqNullSafe(big[f"_big_{c}"]) for c in by]
    large = df.join(big, cond, "left_semi")
    keys = [F.col(c).asc_nulls_first() for c in by]
    tasks = range_tasks(df.sparkSession, total, max_group_rows)
    place = F.monotonically_increasing_id()                     # the range above 33 bits, the row in it below
    cut = materialize(large.repartitionByRange(tasks, *keys, *sorts).sortWithinPartitions(*keys, *sorts).withColumn("_place", place)
                      .withColumn("_slice", 1 + (F.shiftright("_place", 33) * F.lit(1 << 33))
                                  + F.expr(f"(_place & {(1 << 33) - 1}L) div {max(1, max_group_rows)}")).drop("_place"))
    return df.join(big, cond, "left_anti").withColumn("_slice", F.lit(0).cast("long")).unionByName(cut)


def rank_by_range(df: DataFrame, by: Sequence[str], order: str, *, descending: bool = True, name: str = "rank",
                  max_group_rows: int = SLICE_ROWS) -> DataFrame:
    """Exact ``rank()`` over ``partitionBy(by).orderBy(order)`` for any order column, however
    many values it has and however many rows share one.

    Ties may be cut: the row's number within its input breaks them, so a value that fills a
    third of a group spreads over slices too. A row's rank is its rank in the slice plus
    the group's rows in earlier slices; for the value at a slice's head, the rows of that
    value in earlier slices are taken off again.
    """
    sort = _sort(order, descending)
    mixed = df.withColumn("_tie", F.monotonically_increasing_id())
    sliced = range_slices(mixed, by, [sort, F.col("_tie")], max_group_rows).drop("_tie")
    ranked = sliced.withColumn("_r", F.rank().over(Window.partitionBy(*by, "_slice").orderBy(sort)))
    parts = materialize(
        ranked.filter("_slice > 0").groupBy(*by, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_r").alias("_last"), F.min_by(order, "_r").alias("_head"),
             F.max_by(order, "_r").alias("_tail")))
    tails = parts.select(*by, "_slice", F.col("_tail").alias("_value"), (F.col("_n") - F.col("_last") + 1).alias("_c"), F.lit(1).alias("_k"))
    heads = parts.select(*by, "_slice", F.col("_head").alias("_value"), F.lit(0).cast("long").alias("_c"), F.lit(0).alias("_k"))
    of_value = (Window.partitionBy(*by, "_value").orderBy("_slice", "_k")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    equal = (heads.unionByName(tails).withColumn("_equal", F.sum("_c").over(of_value)).filter("_k = 0")
             .select(*by, "_slice", "_equal"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .select(*[F.col(c).alias(f"_p_{c}") for c in by], F.col("_slice").alias("_p"), "_head", "_before"))
    equal = equal.select(*[F.col(c).alias(f"_e_{c}") for c in by], F.col("_slice").alias("_e"), "_equal")
    carried = carried.join(equal, (F.col("_p") == F.col("_e")) & _same(by, "_p_", "_e_"))
    carried = materialize(carried.select(*[f"_p_{c}" for c in by], "_p", "_head", "_before", "_equal"))
    joined = ranked.join(carried, (F.col("_slice") == F.col("_p")) & _same(by, "", "_p_"), "left")
    again = F.when(F.col(order).eqNullSafe(F.col("_head")), F.col("_equal")).otherwise(0)
    return joined.withColumn(name, F.col("_r") + F.coalesce(F.col("_before") - again, F.lit(0))).select(*df.columns, name)


def _same(by: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
    return out


def lag_by_range(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, *,
                 max_group_rows: int = SLICE_ROWS) -> DataFrame:
    """``lag(value, 1)`` over ``partitionBy(by).orderBy(order)`` (ascending, nulls first; a
    total order within a group), for groups of any size and any distribution of ``order``.

    Slices of a large group are sorted on their own; the last value of each is carried into
    the next through a table of one row a slice.
    """
    sorts = [F.col(c).asc_nulls_first() for c in order]
    sliced = range_slices(df, by, sorts, max_group_rows)
    last = materialize(sliced.filter("_slice > 0").groupBy(*by, "_slice").agg(F.max_by(F.col(value), F.struct(*order)).alias("_last")))
    previous = Window.partitionBy(*by).orderBy("_slice")
    carried = last.select(*[F.col(c).alias(f"_p_{c}") for c in by], F.col("_slice").alias("_p"), F.lag("_last").over(previous).alias("_carried"))
    w = Window.partitionBy(*by, "_slice").orderBy(*sorts)
    inside = sliced.withColumns({name: F.lag(value).over(w), "_first": F.row_number().over(w) == 1})
    joined = inside.join(materialize(carried), (F.col("_slice") == F.col("_p")) & _same(by, "", "_p_"), "left")
    return (joined.withColumn(name, F.when(F.col("_first") & (F.col("_slice") > 0), F.col("_carried")).otherwise(F.col(name)))
            .select(*df.columns, name))


def top_n(df: DataFrame, by: Sequence[str], order: str, n: int, *, descending: bool = True,
          name: str = "rank", method: str = "window") -> DataFrame:
    """Rows with ``rank() <= n`` per group (ties kept, so a group may return more).

    ``method='window'`` plans a partial ``WindowGroupLimit`` before the shuffle;
    the surviving ties of a group still meet in one task. ``'histogram'`` ranks
    the (group, value) histogram and filters rows map-side with no sort at all:
    use it when ``order`` has few distinct values (ties are then massive in big
    groups).
    """
    if method == "histogram":
        return rank_by_histogram(df, by, order, descending=descending, name=name, max_rank=n)
    if method != "window":
        raise ValueError(f"method must be 'window' or 'histogram', got {method!r}")
    return rank_within(df, by, order, descending=descending, name=name).filter(F.col(name) <= n)


def first_by(value: str | Column, *order: Column) -> Column:
    """Aggregate: ``value`` of the row that is smallest by ``order`` (a struct).

    Deterministic replacement for an unordered ``first``; combinable map-side.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.struct(*order))
