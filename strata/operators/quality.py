"""Ordered validation rules with a one-pass rejected-row report.

A source is first reduced to one row per key (keyed rules R1/R2), then each row
rule is applied in order. Every count in the report comes from one aggregate over
the de-duplicated frame, not from an action per rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["source", "rule_order", "rule", "rows_in", "rejected", "rows_out"]


@dataclass(frozen=True)
class Rule:
    """A row rule: ``keep()`` builds the predicate of rows that pass.

    A null predicate value rejects the row (as ``filter`` does).
    """
    order: int
    name: str
    keep: Callable[[], Column]

    def passes(self) -> Column:
        return F.coalesce(self.keep(), F.lit(False))


def key_present(key: str) -> Column:
    """R1: key not null and not empty."""
    return F.col(key).isNotNull() & (F.col(key) != F.lit(""))


def dedup_by_key(df: DataFrame, key: str, order: Optional[Sequence[str]] = None, *,
                 with_count: bool = False) -> DataFrame:
    """One row per key: the smallest row by ``order`` (ascending, nulls first).

    Runs as a hash aggregate of ``min(struct(order))``, which is combined map-side,
    so a key holding a large share of the rows is reduced before the shuffle.
    ``with_count`` adds ``_n``, the number of input rows of the key.
    """
    order = list(order or [c for c in df.columns if c != key])
    aggs = [F.min(F.struct(*order)).alias("_row")]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    out = df.groupBy(key).agg(*aggs)
    cols = [F.col(key)] + [F.col(f"_row.{c}").alias(c) for c in order]
    if with_count:
        cols.append(F.col("_n"))
    return out.select(*cols)


def dedup_groups_by_key(df: DataFrame, key: str, groups: Sequence[Sequence[str]]) -> DataFrame:
    """One row per key with, for each column group independently, the values of
    the group's smallest row (ascending, nulls first), plus ``_n`` rows per key.

    One map-side-combined aggregate de-duplicates several projections of the same
    rows at once (e.g. both halves of a vertical split), with no join after it.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.min(F.struct(*g)).alias(f"_g{i}") for i, g in enumerate(groups)]
    out = df.groupBy(key).agg(*aggs)
    cols = [F.col(key), F.col("_n")]
    for i, g in enumerate(groups):
        cols += [F.col(f"_g{i}.{c}").alias(c) for c in g]
    return out.select(*cols)


def dedup_side_by_side(left: DataFrame, right: DataFrame, key: str, orders: Sequence[Sequence[str]],
                       counts: Sequence[str]) -> DataFrame:
    """One row per key of either source, with the values of each source's smallest row and its
    number of rows (``counts``; null where the source has no such key).

    The join reads both aggregates as they are dealt out, so it adds no exchange. A null key
    meets no other: each source keeps a row of its own for it.
    """
    one, other = (dedup_by_key(df, key, order, with_count=True).withColumnRenamed("_n", n)
                  for df, order, n in zip((left, right), orders, counts))
    return one.join(other, key, "full_outer")


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every rule (filters are pushed down by Catalyst)."""
    out = df
    for r in sorted(rules, key=lambda r: r.order):
        out = out.filter(r.passes())
    return out


def first_failure(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rule") -> DataFrame:
    """Tag each row with the first rule (in order) it fails; null if it passes all."""
    tag = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: r.order, reverse=True):
        tag = F.when(~r.passes(), F.lit(r.name)).otherwise(tag)
    return df.withColumn(name, tag)


@dataclass(frozen=True)
class Validated:
    """Outcome of ``validate``: kept rows, the per-key frame and the rule list."""
    source: str
    key: str
    rules: tuple
    per_key: DataFrame          # one row per key (null and '' included) with ``_n``
    kept: DataFrame
    r1_name: str = "R1_key_not_blank"
    r2_name: str = "R2_unique_key"
    n: str = "_n"               # the frame's row count of this source; null: the source has no such key

    def present(self) -> Column:
        """R1, for the keys that this source has."""
        return key_present(self.key) & F.col(self.n).isNotNull()

    def flags(self, prefix: str) -> list[Column]:
        """Per-key columns the report is counted from: row count, key valid, and
        'passed every rule up to i' for each rule in order."""
        valid = self.present()
        out = [F.col(self.n).alias(f"{prefix}_n"), valid.alias(f"{prefix}_valid")]
        passed = valid
        for i, r in enumerate(self.rules):
            passed = passed & r.passes()
            out.append(passed.alias(f"{prefix}_p{i}"))
        return out

    def count_aggs(self, prefix: str) -> list[Column]:
        """Aggregates over a frame holding ``flags(prefix)`` (null = key absent)."""
        n, valid = F.col(f"{prefix}_n"), F.col(f"{prefix}_valid")
        aggs = [F.coalesce(F.sum(n), F.lit(0)).alias(f"{prefix}_rows"),
                F.coalesce(F.sum(F.when(~valid, n)), F.lit(0)).alias(f"{prefix}_r1"),
                F.count_if(valid).alias(f"{prefix}_d")]
        aggs += [F.count_if(F.col(f"{prefix}_p{i}")).alias(f"{prefix}_k{i}")
                 for i in range(len(self.rules))]
        return aggs

    def report_rows(self, prefix: str) -> list[tuple]:
        """(order, rule, rows_in, rejected) expressions over the ``count_aggs`` row."""
        n, r1, d = (F.col(f"{prefix}_{x}") for x in ("rows", "r1", "d"))
        out = [(F.lit(1), F.lit(self.r1_name), n, r1),
               (F.lit(2), F.lit(self.r2_name), n - r1, n - r1 - d)]
        rows_in = d
        for i, r in enumerate(self.rules):
            kept = F.col(f"{prefix}_k{i}")
            out.append((F.lit(r.order), F.lit(r.name), rows_in, rows_in - kept))
            rows_in = kept
        return out

    @property
    def report(self) -> DataFrame:
        """This source's report rows from one aggregate over the per-key frame."""
        s = self.per_key.select(self.key, *self.flags("s")).agg(*self.count_aggs("s"))
        return report_rows(s, self.source, self.report_rows("s"))


def validated_from(per_key: DataFrame, source: str, key: str, rules: Sequence[Rule],
                   columns: Sequence[str], n: str = "_n") -> Validated:
    """``Validated`` over an existing per-key frame with a row count ``n``, e.g. one half of
    ``dedup_groups_by_key`` or ``dedup_side_by_side``."""
    rules = tuple(sorted(rules, key=lambda r: r.order))
    present = key_present(key) & F.col(n).isNotNull()
    kept = apply_rules(per_key.filter(present).select(key, *columns), rules)
    return Validated(source, key, rules, per_key, kept, n=n)


def validate(df: DataFrame, source: str, key: str, rules: Sequence[Rule],
             order: Optional[Sequence[str]] = None, *,
             prepare: Optional[Callable[[DataFrame], DataFrame]] = None) -> Validated:
    """R1 (key present) -> R2 (one row per key) -> ``rules`` in order.

    Everything is lazy. ``prepare`` (e.g. persist) is applied to the per-key frame,
    which both the kept rows and the report are derived from.
    """
    rules = tuple(sorted(rules, key=lambda r: r.order))
    order = list(order or [c for c in df.columns if c != key])
    per_key = dedup_by_key(df, key, order, with_count=True)
    if prepare is not None:
        per_key = prepare(per_key)
    kept = apply_rules(per_key.filter(key_present(key)).drop("_n"), rules)
    return Validated(source, key, rules, per_key, kept)


def report_rows(agg_row: DataFrame, source, rows) -> DataFrame:
    """Unpivot one aggregate row into report rows with ``stack``.

    ``rows`` are (order, rule, rows_in, rejected) Column tuples, optionally with a
    leading source name each (then ``source`` is ignored).
    """
    fields = []
    for r in rows:
        src, (o, name, rin, rej) = (r[0], r[1:]) if len(r) == 5 else (source, r)
        fields += [F.lit(src), o.cast("int"), name, rin.cast("bigint"), rej.cast("bigint")]
    st = F.stack(F.lit(len(rows)), *fields).alias("source", "rule_order", "rule", "rows_in",
                                                  "rejected")
    return (agg_row.select(st)
            .select("source", "rule_order", "rule", "rows_in", "rejected",
                    (F.col("rows_in") - F.col("rejected")).alias("rows_out")))


def joint_flags(parent: Validated, child: Validated) -> DataFrame:
    """Per-key frame with both sources' flags. Two frames are full-outer-joined on the key;
    sources that share one keep all its columns, and nothing is joined."""
    key = parent.key
    if parent.per_key is child.per_key:
        return parent.per_key.select("*", *parent.flags("p"), *child.flags("c"))
    p = parent.per_key.select(key, *parent.flags("p"))
    c = child.per_key.select(key, *child.flags("c"))
    return p.join(c, key, "full_outer")


def joint_aggs(parent: Validated, child: Validated) -> list[Column]:
    """The aggregates over ``joint_flags`` that ``joint_rows`` is made of."""
    last_p = F.coalesce(F.col(f"p_p{len(parent.rules) - 1}") if parent.rules else F.col("p_valid"),
                        F.lit(False))
    last_c = F.coalesce(F.col(f"c_p{len(child.rules) - 1}") if child.rules else F.col("c_valid"),
                        F.lit(False))
    return [*parent.count_aggs("p"), *child.count_aggs("c"),
            F.count_if(last_c).alias("x_in"), F.count_if(last_c & ~last_p).alias("x_orphans")]


def joint_rows(agg_row: DataFrame, parent: Validated, child: Validated, order: int, name: str) -> DataFrame:
    """Report rows of both sources and of the child-in-parent rule from one row of ``joint_aggs``."""
    ref = [(F.lit(order), F.lit(name), F.col("x_in"), F.col("x_orphans"))]
    rows = ([(parent.source, *r) for r in parent.report_rows("p")]
            + [(child.source, *r) for r in child.report_rows("c") + ref])
    return report_rows(agg_row, None, rows)


def joint_report(parent: Validated, child: Validated, order: int, name: str) -> DataFrame:
    """Both sources' rule reports plus the child-in-parent rule, in one pass: a single
    aggregate yields every count."""
    s = joint_flags(parent, child).agg(*joint_aggs(parent, child))
    return joint_rows(s, parent, child, order, name)
