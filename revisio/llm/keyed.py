"""Candidate pairs of rows (node, key) that share a key, without all pairs of a linked group.

Rounds of stars first join a key's rows to one of them; once what links is one component, only
rows of one key with different labels are left to pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shared_keys(rows: DataFrame) -> DataFrame:
    """Distinct (key, node) of the keys that two nodes have; counts meet before rows do."""
    several = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    return rows.select("key", "node").join(several, "key").distinct()


def open_rows(shared: DataFrame, components: DataFrame | None) -> DataFrame:
    """Rows of shared (key, node, ...) with a label, for the keys that still have two labels."""
    state = shared.withColumn("label", F.col("node"))
    if components is not None:
        state = shared.join(components, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    keys = state.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return state.join(keys, "key")


def stars(state: DataFrame, order: Column, fits=None) -> DataFrame:
    """Pairs (a, b) of each key's row of the least order with the key's rows of other labels. fits: a condition on (row's n, other's n)."""
    one = state.groupBy("key").agg(F.min_by(F.struct(*(c for c in state.columns if c != "key")), order).alias("one"))
    apart = F.col("label") != F.col("one.label")
    pairs = state.join(one, "key").where(apart if fits is None else apart & fits("n", "one.n"))
    return pairs.select(F.least("node", "one.node").alias("a"), F.greatest("node", "one.node").alias("b")).distinct()


def nearest_stars(state: DataFrame, order: Column) -> DataFrame:
    """As `stars`, but for each row's node only the one that it shares most keys with: a pair a node at most."""
    one = state.groupBy("key").agg(F.min_by(F.struct("node", "label"), order).alias("one"))
    met = state.join(one, "key").where(F.col("label") != F.col("one.label")).groupBy("node", F.col("one.node").alias("other")).agg(F.count("*").alias("n"))
    best = met.groupBy("node").agg(F.max(F.struct("n", "other"))["other"].alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def all_pairs(state: DataFrame, fits=None, extra: Column | None = None) -> DataFrame:
    """Pairs (a, b) of all rows of a key with different labels. extra: a condition on columns named l... and r..."""
    side = lambda s: state.select("key", *(F.col(c).alias(s + c) for c in state.columns if c != "key"))
    both = (F.col("lnode") < F.col("rnode")) & (F.col("llabel") != F.col("rlabel"))
    for more in ([] if fits is None else [fits("ln", "rn")]) + ([] if extra is None else [extra]):
        both = both & more
    return side("l").join(side("r"), "key").where(both).select(F.col("lnode").alias("a"), F.col("rnode").alias("b")).distinct()


def whole_groups(batches: Iterator[pd.DataFrame], of: list[str], least: int = 100_000) -> Iterator[pd.DataFrame]:
    """Frames of about `least` rows that end where a group ends; rows come in the groups' order."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in batches:
        held.append(frame)
        size += len(frame)
        if size < least:
            continue
        rows = pd.concat(held, ignore_index=True)
        others = np.flatnonzero((rows[of] != rows[of].iloc[-1]).any(axis=1))
        end = int(others[-1]) + 1 if len(others) else 0
        if end:
            yield rows.iloc[:end].reset_index(drop=True)
        held, size = [rows.iloc[end:]], size - end
    if size:
        yield pd.concat(held, ignore_index=True)
