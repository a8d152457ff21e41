"""What of the planned history is captured, and a bounded resume of the rest [K30]."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.operators import windows

MOST = 60


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """site_key, window_start, window_end, complete and file of each manifest below a folder; what is no JSON is left out."""
    rows = spark.read.text(f"{folder}/*/manifest.json", wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("m")).where("m IS NOT NULL")
    get = lambda name: F.try_variant_get("m", f"$.{name}", "string")
    gaps = F.coalesce(F.size(F.try_variant_get("m", "$.coverage_gaps", "array<variant>")), F.lit(0))
    instant = lambda name: F.try_to_timestamp(get(name)).cast("timestamp_ntz")
    return rows.select(get("site_key").alias("site_key"), instant("requested_starttime").alias("window_start"), instant("requested_endtime").alias("window_end"), ((get("status") == "complete") & (gaps <= 0)).alias("complete"), "file")


def captured(planned: DataFrame, manifests: DataFrame) -> DataFrame:
    """Planned windows with the number of complete captures of exactly their site and range, and the last one's file."""
    good = manifests.where("complete").groupBy("site_key", "window_start", "window_end").agg(F.count("*").alias("captures"), F.max("file").alias("file"))
    return planned.join(good, ["site_key", "window_start", "window_end"], "left").fillna(0, ["captures"])


def pending(planned: DataFrame, manifests: DataFrame) -> DataFrame:
    """Planned windows without a complete capture."""
    return planned.join(manifests.where("complete").select("site_key", "window_start", "window_end"), ["site_key", "window_start", "window_end"], "left_anti")


def resume(spark: SparkSession, cutoff: datetime, folder: str | None, most: int, run: Callable[..., dict[str, Any]] | None, *, first: int = 1, days: int | None = None, hours: int | None = None) -> list[int]:
    """Capture at most `most` pending windows from number `first` on, stopping at the first that is not complete.

    run: called with (site_key, start, end, days=, hours=), returns a manifest; null: a preview.
    days, hours: slices of the source's windows; hours only within single days.
    """
    planned = windows.history_windows(spark, cutoff)
    if not 1 <= most <= MOST or not 1 <= first <= planned.count():
        raise ValueError("the number of windows or the first one is out of range")
    if days is not None and not 1 <= days <= 7 or hours is not None and (days != 1 or not 1 <= hours <= 12):
        raise ValueError("slices are of 1 to 7 days, or of 1 to 12 hours of a day")
    open_ = pending(planned, manifests(spark, folder)) if folder else planned
    rows = open_.where(F.col("window_no") >= first).orderBy("window_no").limit(most).collect()
    for r in rows if run else []:
        manifest = run(r.site_key, r.window_start, r.window_end, days=days, hours=hours)
        if manifest.get("status") != "complete" or manifest.get("coverage_gaps"):
            raise RuntimeError(f"window {r.window_no} is not complete")
    return [r.window_no for r in rows]
