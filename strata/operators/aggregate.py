"""Grouped statistics with exact averages and deterministic "best row" picks."""

from __future__ import annotations

from typing import Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import SCALE, exact_avg


def best_by(value: str, order: str, *, descending: bool = True,
            tie_break: Sequence[str] = ()) -> Column:
    """Aggregate: ``value`` of the row with the largest (or smallest) ``order``;
    nulls of ``order`` lose, ties go to the smallest ``tie_break`` values.

    A ``min_by`` over a struct key, so it combines map-side like any aggregate
    (no window, no self-join).
    """
    o = F.col(order)
    key = [o.isNull(), -o if descending else o] + [F.col(c) for c in tie_break]
    return F.min_by(F.col(value), F.struct(*key))


def group_stats(df: DataFrame, keys: Sequence[str], *, averages: Mapping[str, int] = None,
                count_of: Optional[str] = None, count_name: str = "n",
                extra: Sequence[Column] = (), integers: Sequence[str] = (),
                scale: int = SCALE) -> DataFrame:
    """``groupBy(keys)`` with ``avg_<col>`` rounded to the given digits (exact,
    partition-independent), a ``count(count_of)`` and any extra aggregates.

    ``integers`` names columns of whole numbers, which are summed as longs; the others
    are summed with ``scale`` fractional digits.
    """
    aggs = [exact_avg(c, digits, scale=scale, integral=c in integers).alias(f"avg_{c}")
            for c, digits in (averages or {}).items()]
    if count_of is not None:
        aggs.append(F.count(count_of).alias(count_name))
    aggs.extend(extra)
    return df.groupBy(*keys).agg(*aggs)
