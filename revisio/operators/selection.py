"""Exact percentiles by distributed selection [D6].

A pass cuts the range that holds a wanted rank into buckets and counts them; the rank lies in one
of these, whose rows alone are read by the next pass. Splitters come from a mergeable quantile
sketch, so that buckets hold about as many rows each however the values are spread; the counts
are exact, so that the result does not rest on the sketch. When the bucket holds few distinct
values or rows, they are grouped and the value at the rank is read off. Each pass shrinks the
range by the number of buckets: a trillion rows take five.

Groups and ranks advance together, and what a pass returns is a count for each range and bucket. No task ever sees a group's rows or distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import pairwise
from math import floor
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, SMALL, GROUPS, ACCURACY, AT_ONCE = 64, 4_096, 512, 1_000, 16


@dataclass
class _Range:
    """A group's values from `low` on, and below `high` (None: no bound), with so many rows before them, and the ranks wanted among them."""

    group: tuple
    before: int
    rows: int
    ranks: set[int]
    low: float | None = None
    high: float | None = None
    splitters: list[float] = field(default_factory=list)

    def holds(self, value: Column) -> Column:
        held = F.lit(True)
        if self.low is not None:
            held = held & (value >= F.lit(self.low))
        if self.high is not None:
            held = held & (value < F.lit(self.high))
        return held


def _order(x: float) -> tuple[bool, float]:
    """NaN is above all numbers, and equal to itself."""
    return (True, 0.0) if x != x else (False, x)


def _above(x: float, low: float | None) -> bool:
    return low is None or _order(x) > _order(low)


def _bucket(value: Column, splitters: Sequence[float], first: int = 0) -> Column:
    """How many splitters are not above the value, as nested comparisons."""
    if not splitters:
        return F.lit(first)
    k = len(splitters) // 2
    return F.when(value < F.lit(splitters[k]), _bucket(value, splitters[:k], first)).otherwise(_bucket(value, splitters[k + 1 :], first + k + 1))


def _same(group: Sequence[Any], keys: Sequence[str]) -> Column:
    held = F.lit(True)
    for k, v in zip(keys, group, strict=True):
        held = held & F.col(k).eqNullSafe(F.lit(v))
    return held


def _dealt(rows: DataFrame, keys: Sequence[str], value: Column, ranges: Sequence[_Range], bucketed: bool) -> DataFrame:
    """Rows of the ranges: the range's number, the value and its bucket. Ranges do not overlap."""
    inside = [_same(r.group, keys) & r.holds(value) for r in ranges]
    which, bucket = F.lit(None).cast("int"), F.lit(0)
    for k, (held, r) in enumerate(zip(inside, ranges, strict=True)):
        which = F.when(held, F.lit(k)).otherwise(which)
        if bucketed:
            bucket = F.when(held, _bucket(value, r.splitters)).otherwise(bucket)
    return rows.where(reduce(Column.__or__, inside)).select(which.alias("range"), value.alias("value"), bucket.alias("bucket"))


def _read_off(rows: DataFrame, keys: Sequence[str], value: Column, ranges: Sequence[_Range]) -> dict[tuple, float]:
    """The values at the ranks of ranges of few rows, from their distinct values and counts."""
    seen, out = [r.before for r in ranges], {}
    counted = _dealt(rows, keys, value, ranges, False).groupBy("range", "value").count().collect()
    for r in sorted(counted, key=lambda r: (r.range, *_order(r.value))):
        held = ranges[r.range]
        out.update({(held.group, k): r.value for k in held.ranks if seen[r.range] <= k < seen[r.range] + r["count"]})
        seen[r.range] += r["count"]
    return out


def _split(rows: DataFrame, keys: Sequence[str], value: Column, ranges: Sequence[_Range], buckets: int) -> tuple[list[_Range], dict[tuple, float]]:
    """The buckets that hold the ranks, and the values of ranges that one value fills."""
    fractions, out = [k / buckets for k in range(1, buckets)], {}
    sketched = _dealt(rows, keys, value, ranges, False).groupBy("range").agg(F.percentile_approx("value", fractions, ACCURACY).alias("s"), F.max("value").alias("most")).collect()
    for r in sketched:
        held = ranges[r.range]
        held.splitters = sorted({x for x in [*r.s, r.most] if _above(x, held.low)}, key=_order)  # the largest value has a bucket of its own, so that each pass ends a range or makes it smaller
        if not held.splitters:
            out.update({(held.group, k): r.most for k in held.ranks})
    mixed = [r for r in ranges if r.splitters]
    counts = {(r.range, r.bucket): r["count"] for r in _dealt(rows, keys, value, mixed, True).groupBy("range", "bucket").count().collect()} if mixed else {}
    parts = []
    for k, r in enumerate(mixed):
        before, bounds = r.before, [r.low, *r.splitters, r.high]
        for b, (low, high) in enumerate(pairwise(bounds)):
            here = counts.get((k, b), 0)
            if some := {x for x in r.ranks if before <= x < before + here}:
                parts.append(_Range(r.group, before, here, some, low, high))
            before += here
    return parts, out


def order_statistics(rows: DataFrame, value: str, ranks: dict[tuple, set[int]], totals: dict[tuple, int], keys: Sequence[str] = (), buckets: int = BUCKETS, small: int = SMALL) -> dict[tuple, float]:
    """{(group, rank): value} of the ranks (from 0) wanted of each group's non-null values."""
    v = F.col(value)
    rows = rows.where(v.isNotNull())
    todo = [_Range(g, 0, totals[g], set(wanted)) for g, wanted in ranks.items()]
    out: dict[tuple, float] = {}
    while todo:
        few = [r for r in todo if r.rows <= small][:AT_ONCE]
        if few:
            out.update(_read_off(rows, keys, v, few))
            todo = [r for r in todo if r not in few]
        else:
            parts, found = _split(rows, keys, v, todo[:AT_ONCE], buckets)
            todo = todo[AT_ONCE:] + parts
            out.update(found)
    return out


def percentiles(rows: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = (), names: Sequence[str] | None = None, groups_at_most: int = GROUPS, buckets: int = BUCKETS, small: int = SMALL) -> DataFrame:
    """A row for each group: `n` non-null values, `least`, `most`, and a column for each fraction, interpolated between neighbours.

    Nulls do not count; NaN is above all numbers, as it sorts. A group without values has nulls.
    More than groups_at_most groups are refused: the ranges of all groups advance together.
    """
    spark, v = rows.sparkSession, F.col(value)
    rows = rows.select(*keys, v.cast("double").alias(value))
    told = rows.groupBy(*keys).agg(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"))
    facts = told.limit(groups_at_most + 1).collect()
    if len(facts) > groups_at_most:
        raise ValueError(f"more than {groups_at_most} groups")
    totals = {tuple(r[k] for k in keys): r.n for r in facts}
    places = {(g, p): (n - 1) * p for g, n in totals.items() if n for p in fractions}
    wanted: dict[tuple, set[int]] = {}
    for (g, _), h in places.items():
        wanted.setdefault(g, set()).update((floor(h), min(floor(h) + 1, totals[g] - 1)))
    at = order_statistics(rows, value, wanted, totals, keys, buckets, small)

    def between(g: tuple, p: float) -> float | None:
        if (g, p) not in places:
            return None
        h = places[g, p]
        low, high = at[g, floor(h)], at[g, min(floor(h) + 1, totals[g] - 1)]
        return low if low == high or h == floor(h) else low + (high - low) * (h - floor(h))

    names = names or [f"p{p * 100:g}".replace(".", "_") for p in fractions]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema if f.name in keys}
    ddl = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["n bigint", "least double", "most double"] + [f"{n} double" for n in names])
    return spark.createDataFrame([(*(r[k] for k in keys), r.n, r.least, r.most, *(between(tuple(r[k] for k in keys), p) for p in fractions)) for r in facts], ddl)
