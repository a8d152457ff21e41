"""MERGE, UPDATE and DELETE as rewrites of a whole table [A16-A20, C10].

File tables take no MERGE; each function returns the table's next state, and the snapshot
store publishes it. Counts come from one aggregate over the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WHEN NOT MATCHED THEN INSERT: the rows to append."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Next state with merge_action (kept, updated, inserted). condition sees t.* and s.*; only `update` columns change."""
    t, s = target.withColumn("in_t", F.lit(True)).alias("t"), source.select(*target.columns).withColumn("in_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if k not in keys else F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full")
    new = F.col("t.in_t").isNull()
    change = F.col("s.in_s").isNotNull() & ~new & (F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True))
    columns = [F.when(new | change if c in update else new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return both.select(*columns, F.when(new, "inserted").when(change, "updated").otherwise("kept").alias("merge_action"))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], assign: dict[str, str], where: Column | None = None) -> DataFrame:
    """UPDATE t SET column = s.column FROM s: columns of matched rows that satisfy `where` (over t.*)."""
    s = source.select(*keys, *(F.col(v).alias(f"upd_{k}") for k, v in assign.items()), F.lit(True).alias("upd_hit"))
    joined = target.alias("t").join(s, list(keys), "left")
    hit = F.coalesce(F.col("upd_hit"), F.lit(False)) & (F.coalesce(where, F.lit(False)) if where is not None else F.lit(True))
    return joined.select(*(F.when(hit, F.col(f"upd_{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in assign else F.col(c if c in keys else f"t.{c}") for c in target.columns))


def delete(target: DataFrame, keys_to_go: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_to_go.select(*keys), list(keys), "left_anti").select(*target.columns)


class CountDiffers(ValueError):
    """A rewrite would touch another number of rows than was expected; nothing is swapped."""


def checked(rows: DataFrame, expected: int, what: str, touched: Column | None = None) -> DataFrame:
    """The rows, if as many of them as expected are `touched` (of all, if not given) [A19]. Counted before the swap."""
    n = rows.agg(F.count_if(F.coalesce(touched, F.lit(False))) if touched is not None else F.count("*")).first()[0]
    if n != expected:
        raise CountDiffers(f"{what}: {n} rows instead of {expected}")
    return rows
