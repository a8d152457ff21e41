"""Update sweeps: their plan, their validation, and loading one before its watermark moves [I5-I8]."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revisio.operators import views
from revisio.plans.store import Store
from revisio.sources import landing

#: Windows of an audit that one task sorts, beside the counts and requests of their attempts.
TASK_WINDOWS = 250_000


def _utc(value: str | datetime) -> datetime:
    at = datetime.fromisoformat(value) if isinstance(value, str) else value
    if at.tzinfo is None:
        raise ValueError("instants need a time zone")
    return at.astimezone(UTC)


def plan(low: str | datetime, cutoff: str | datetime, watermark: str | datetime, started: str | datetime, overlap_seconds: int) -> dict[str, Any]:
    """What a sweep asks for: origins from low to cutoff, updated after the watermark less the overlap. Success proposes its start as the next watermark."""
    low, cutoff, watermark, started = map(_utc, (low, cutoff, watermark, started))
    if not low < cutoff or watermark > started or overlap_seconds < 0:
        raise ValueError("a sweep has a range, a watermark before its start and an overlap of no less than zero")
    after = watermark - timedelta(seconds=overlap_seconds)
    return {
        "catalog_lower_bound": low.isoformat(), "origin_time_cutoff": cutoff.isoformat(), "last_committed_watermark": watermark.isoformat(), "sweep_started_at": started.isoformat(),
        "overlap_seconds": overlap_seconds, "query_parameters": {"format": "geojson", "updatedafter": after.isoformat()}, "proposed_watermark_after_success": started.isoformat(),
    }


def tasks_for(spark: SparkSession, windows: int) -> int:
    """Tasks to deal an audit's attempts to: their number grows with the windows, so that what one holds does not."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-windows // TASK_WINDOWS))


def coverage(audit: DataFrame, requests: DataFrame, counts: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per requested attempt: what its audit leaves open, and sweep_state (`complete`, or the first problem) [I7].

    audit: attempt_id, window_id, window_status, window_starttime, window_endtime, count_before,
    returned_rows, count_after. requests: attempt_id, low, cutoff. counts: attempt_id, window_id,
    window_rows, of the windows that have rows. Settled windows must join end to start from low to
    cutoff. Each input is read once: their rows are dealt by attempt together, and every window
    and the grouping rest on that one exchange. tasks: those of `tasks_for`, if the caller has
    counted the windows already.
    """
    tasks = tasks or tasks_for(audit.sparkSession, audit.count())
    told = lambda kind, rows: rows.withColumn("kind", F.lit(kind))
    every = told("audit", audit).unionByName(told("request", requests), allowMissingColumns=True).unionByName(told("count", counts), allowMissingColumns=True).repartition(tasks, "attempt_id")
    kind, n, named = F.col("kind"), F.col("returned_rows"), F.col("window_id").isNotNull()
    leaf = F.coalesce((kind == "audit") & (F.col("window_status") == "reconciled"), F.lit(False))
    attempt, window = Window.partitionBy("attempt_id"), Window.partitionBy("attempt_id", "window_id")
    order = Window.partitionBy("attempt_id", "leaf").orderBy("window_starttime", "window_endtime", "window_id")
    marked = every.withColumn("leaf", leaf).withColumns({
        "low": F.max("low").over(attempt), "cutoff": F.max("cutoff").over(attempt), "asked": F.max(kind == "request").over(attempt),
        "rows": F.when(named, F.max("window_rows").over(window)), "has_leaf": F.coalesce(F.when(named, F.max("leaf").over(window)), F.lit(False)), "before": F.lag("window_endtime").over(order),
    }).where("asked")
    settled = F.col("leaf")
    begin = F.coalesce("before", "low")
    equal = F.col("count_before").eqNullSafe(n) & n.eqNullSafe(F.col("count_after"))
    of_leaves = lambda wrong: F.count_if(settled & F.coalesce(wrong, F.lit(False)))
    out = marked.groupBy("attempt_id").agg(
        F.count_if(settled).alias("leaves"), F.max(F.when(settled, F.col("window_endtime"))).alias("upto"), F.max("cutoff").alias("cutoff"),
        of_leaves((F.col("window_starttime") != begin) | (F.col("window_endtime") <= F.col("window_starttime"))).alias("breaks"),
        of_leaves(~equal | n.isNull() | (n < 0)).alias("unequal_counts"),
        (F.count(F.when(settled, F.lit(1))) - F.count_distinct(F.when(settled, F.col("window_id")))).alias("repeated_windows"),
        of_leaves(F.coalesce("rows", F.lit(0)) != F.coalesce(n, F.lit(0))).alias("differing_rows"),
        F.count_if((kind == "audit") & ~F.coalesce(F.col("window_status").isin("reconciled", "split"), F.lit(False))).alias("unsettled"),
        F.count_if((kind == "count") & ~F.col("has_leaf")).alias("stray_windows"),
    )
    state = (
        F.when((F.col("unsettled") > 0) | (F.col("leaves") == 0), "unsettled windows").when((F.col("breaks") > 0) | ~F.col("upto").eqNullSafe(F.col("cutoff")), "range not covered")
        .when((F.col("unequal_counts") > 0) | (F.col("repeated_windows") > 0), "counts disagree").when((F.col("differing_rows") > 0) | (F.col("stray_windows") > 0), "rows differ").otherwise("complete")
    )
    return out.select("attempt_id", "leaves", "breaks", "unsettled", "unequal_counts", "repeated_windows", "differing_rows", "stray_windows", state.alias("sweep_state"))


def validate(store: Store, manifest: Mapping[str, Any], rows: DataFrame) -> None:
    """Raise unless the manifest is of a complete sweep, asks what its watermark plan says, and its rows and audit agree."""
    if manifest.get("batch_kind") != "update_sweep" or manifest.get("status") != "complete" or manifest.get("coverage_gaps"):
        raise ValueError("a complete update sweep without gaps is required")
    want = plan(*(manifest[k] for k in ("catalog_lower_bound", "origin_time_cutoff", "last_committed_watermark", "sweep_started_at", "overlap_seconds")))
    if differs := sorted(k for k, v in want.items() if manifest.get(k) != v):
        raise ValueError(f"the sweep differs from its plan in {', '.join(differs)}")
    attempt = manifest["attempt_id"]
    audit = _audit(store, manifest)
    requests = store.spark.createDataFrame([(attempt, want["catalog_lower_bound"], want["origin_time_cutoff"])], "attempt_id string, low string, cutoff string").select("attempt_id", F.to_timestamp("low").alias("low"), F.to_timestamp("cutoff").alias("cutoff"))
    state = coverage(audit, requests, landing.window_counts(rows)).first().sweep_state
    if state != "complete":
        raise ValueError(f"sweep {attempt}: {state}")


def _audit(store: Store, manifest: Mapping[str, Any]) -> DataFrame:
    told = store.spark.range(1).select(F.lit(manifest["attempt_id"]).alias("attempt_id"), F.lit(manifest["batch_kind"]).alias("batch_kind"), F.parse_json(F.lit(json.dumps(manifest["window_audit"]))).alias("window_audit"))
    return views.window_audit(told)


def load_and_commit(store: Store, path: str, manifest: Mapping[str, Any], receipt: Mapping[str, Any], *, sweep: str = "updates", initial_watermark: str | None = None, loaded_at: datetime | None = None) -> dict[str, Any]:
    """Load a validated sweep if it is not loaded yet, check what is stored of it, then move the watermark once [I8].

    The catalog's lower bound never changes and its cutoff never goes back; the sweep must be
    planned from the committed watermark, or from initial_watermark if there is none. A sweep
    that is loaded already is only checked, so that a run that stopped can be run again.
    """
    attempt, key = manifest["attempt_id"], f"sweep/{sweep}"
    validate(store, manifest, landing.scan(store.spark, path))
    current = store.state(key)
    if current is None and initial_watermark is None:
        raise ValueError("the first sweep needs an initial watermark")
    if current is not None:
        if _utc(current["catalog_lower_bound"]) != _utc(manifest["catalog_lower_bound"]):
            raise ValueError("the catalog's lower bound changed")
        if _utc(current["origin_time_cutoff"]) > _utc(manifest["origin_time_cutoff"]):
            raise ValueError("the origin cutoff would go back")
    previous = _utc(initial_watermark if current is None else current["committed_watermark"]).isoformat()
    if _utc(manifest["last_committed_watermark"]).isoformat() != previous:
        raise ValueError("stale sweep: the committed watermark is another")

    if load_state(store, attempt, manifest["raw_rows_written"]) == "ready":
        landing.load(store, path, dict(receipt), loaded_at or datetime.now(UTC))
    if (state := load_state(store, attempt, manifest["raw_rows_written"])) != "loaded":
        raise ValueError(f"the sweep's load is in state {state}")
    stored = store.read("batch_attempt").where(F.col("attempt_id") == attempt).select(F.to_json("manifest").alias("m")).first().m
    if json.loads(stored) != json.loads(json.dumps(manifest)):
        raise ValueError("the receipt's manifest differs from the sweep's")
    validate(store, manifest, store.read("raw_event_records").where(F.col("attempt_id") == attempt))
    value = {"committed_watermark": manifest["sweep_started_at"], "previous_watermark": previous, "attempt_id": attempt, "catalog_lower_bound": manifest["catalog_lower_bound"], "origin_time_cutoff": manifest["origin_time_cutoff"]}
    tx = store.transaction()
    tx.compare_and_set(key, current, value)
    tx.commit()
    return value


def load_state(store: Store, attempt_id: str, expected_rows: int) -> str:
    plans = store.spark.createDataFrame([(attempt_id, expected_rows)], "attempt_id string, expected_rows bigint")
    of = lambda table: store.read(table).where(F.col("attempt_id") == attempt_id)
    return views.load_state(plans, of("batch_attempt"), of("raw_event_records").groupBy("attempt_id").agg(F.count("*").alias("raw_rows"))).first().load_state
