"""Distinct counts that merge: bitmaps by bucket, kept for small units and rolled up [D5, K22].

A number is a bit in the bitmap of its bucket of 32,768. A unit (a site and a day) keeps a row for
each bucket that it has seen; a larger unit (a month, a year) is the union of their bits. Counts
are exact and nothing is read again: a day's late events replace that day's rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sketch(rows: DataFrame, number: Column, *unit: str | Column) -> DataFrame:
    """(unit, bucket, bits) of the distinct numbers of each unit; null numbers do not count. Numbers are whole and not negative."""
    n = F.when(number < 0, F.raise_error(F.lit("numbers of a bitmap are not negative")).cast("bigint")).otherwise(number.cast("bigint"))
    held = rows.where(number.isNotNull())
    at = n + 1  # the built-in functions put 1 to 32,768 into the first bucket
    return held.groupBy(*unit, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def roll_up(bitmaps: DataFrame, *unit: str | Column) -> DataFrame:
    """The bitmaps of larger units, which `unit` says of the smaller ones' columns."""
    return bitmaps.groupBy(*unit, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count(bitmaps: DataFrame, unit: Sequence[str], name: str) -> DataFrame:
    """Distinct numbers of each unit; its buckets add up, since no number is in two."""
    return bitmaps.groupBy(*unit).agg(F.sum(F.bitmap_count("bits")).alias(name))
