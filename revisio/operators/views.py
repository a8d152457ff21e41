"""Reporting views and verdicts [K15-K19, K23, K26]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_process(processes: DataFrame, time_col: str = "finished_at") -> DataFrame:
    """The last process attempt of each attempt [E2]. A partial aggregate, no window."""
    rest = [c for c in processes.columns if c != "attempt_id"]
    return processes.groupBy("attempt_id").agg(F.max_by(F.struct(*rest), F.struct(time_col, "process_attempt_id")).alias("p")).select("attempt_id", "p.*")


def health_status(gaps: Column) -> Column:
    """First state that holds, NULL checks before comparisons [K15]. Columns as batch_health names them."""
    c = F.col
    null = lambda *names: F.greatest(*(c(n).isNull() for n in names)) if len(names) > 1 else c(names[0]).isNull()
    raw_differs = null("source_rows_returned", "raw_rows_written", "loaded_rows") | (c("source_rows_returned") != c("raw_rows_written")) | (c("raw_rows_written") != c("loaded_rows")) | (c("loaded_rows") != c("raw_rows"))
    process_differs = (
        null("p_loaded_rows", "processed_rows", "rejected_rows", "f_processed_rows", "f_rejected_rows", "f_attempt_id")
        | (c("p_loaded_rows") != c("loaded_rows")) | (c("processed_rows") != c("p_loaded_rows")) | (c("rejected_rows") > c("processed_rows"))
        | (c("staging_rows") != c("p_loaded_rows")) | (c("staging_reject_rows") != c("rejected_rows"))
        | (c("fact_process_status") != "complete") | (c("f_processed_rows") != c("processed_rows")) | (c("f_rejected_rows") != c("rejected_rows"))
    )
    return (
        F.when(gaps > 0, "SOURCE_GAP").when(c("load_status") != "complete", "LOAD_INCOMPLETE").when(raw_differs, "RAW_COUNT_MISMATCH")
        .when(c("process_attempt_id").isNull(), "PENDING_PROCESS").when(c("process_status") != "complete", "PROCESS_FAILED")
        .when(process_differs, "PROCESS_COUNT_MISMATCH").otherwise("RECONCILED")
    )


def batch_health(attempts: DataFrame, raw_counts: DataFrame, staging_counts: DataFrame, processes: DataFrame, batch_facts: DataFrame, gaps: Column, time_col: str = "finished_at") -> DataFrame:
    """One row per receipt: four left joins on attempt_id [C4]. raw_counts: attempt_id, raw_rows; staging_counts: attempt_id, staging_rows, staging_reject_rows."""
    p = latest_process(processes, time_col).select("attempt_id", "process_attempt_id", F.col("status").alias("process_status"), F.col("loaded_rows").alias("p_loaded_rows"), "processed_rows", "rejected_rows")
    f = batch_facts.select("attempt_id", F.col("attempt_id").alias("f_attempt_id"), F.col("process_status").alias("fact_process_status"), F.col("processed_rows").alias("f_processed_rows"), F.col("rejected_rows").alias("f_rejected_rows"), "fetch_to_curated_seconds")
    joined = attempts.join(raw_counts, "attempt_id", "left").join(staging_counts, "attempt_id", "left").join(p, "attempt_id", "left").join(f, "attempt_id", "left")
    joined = joined.fillna(0, ["raw_rows", "staging_rows", "staging_reject_rows"]).withColumn("receipt_gap_count", gaps)
    return joined.withColumn("health_status", health_status(F.col("receipt_gap_count"))).drop("f_attempt_id")


def window_audit(receipts: DataFrame) -> DataFrame:
    """One row per audited window; an empty or null audit gives none [K16, B12]."""
    get = lambda path, kind: F.try_variant_get("value", path, kind)
    flat = receipts.lateralJoin(receipts.sparkSession.tvf.variant_explode(F.col("window_audit").outer()))
    return flat.select("attempt_id", "batch_kind", get("$.window_id", "string").alias("window_id"), get("$.status", "string").alias("window_status"), F.try_to_timestamp(get("$.starttime", "string")).alias("window_starttime"),
        F.try_to_timestamp(get("$.endtime", "string")).alias("window_endtime"), get("$.count_before", "bigint").alias("count_before"), get("$.returned_rows", "bigint").alias("returned_rows"), get("$.count_after", "bigint").alias("count_after"))


def window_anomalies(audit: DataFrame) -> DataFrame:
    n = ("count_before", "returned_rows", "count_after")
    known = F.col(n[0]).isNotNull() & F.col(n[1]).isNotNull() & F.col(n[2]).isNotNull()
    return audit.where((F.col("window_status") == "unresolved") | (known & ((F.col(n[0]) != F.col(n[1])) | (F.col(n[1]) != F.col(n[2])))))


def rejects(staging: DataFrame) -> DataFrame:
    return staging.where("reject_reason IS NOT NULL").select("attempt_id", "window_id", "stage_file_name", "stage_file_row_number", "source_event_id", "reject_reason", "projected_at")


def reconciliation(health: DataFrame) -> DataFrame:
    """Totals by state [K18]."""
    total = lambda c, name: F.sum(F.coalesce(F.col(c), F.lit(0))).alias(name)
    return health.groupBy("health_status").agg(F.count("*").alias("attempts"), F.sum("loaded_rows").alias("receipt_loaded_rows"), F.sum("raw_rows").alias("observed_raw_rows"), F.sum("staging_rows").alias("observed_staging_rows"), total("processed_rows", "processed_rows"), total("rejected_rows", "rejected_rows"))


def batch_anomalies(health: DataFrame) -> DataFrame:
    """Attempts that are neither reconciled nor waiting [K18]."""
    return health.where(~F.col("health_status").isin("RECONCILED", "PENDING_PROCESS")).select("attempt_id", "health_status", "loaded_rows", "raw_rows", "staging_rows", "processed_rows", "rejected_rows", "receipt_gap_count")


def day_sample(current: DataFrame, bridge: DataFrame, site_key: str, start: Column, end: Column) -> DataFrame:
    """Current events of one site's radius and one half-open time range: count and extremes; no row if there are none [K21]."""
    near = bridge.where((F.col("site_key") == site_key) & F.col("within_radius"))
    some = current.where((F.col("origin_time") >= start) & (F.col("origin_time") < end)).join(near, ["canonical_event_id", "source_updated_at", "payload_hash"])
    return some.groupBy("site_key").agg(
        F.count("*").alias("current_events_within_radius"), F.min("magnitude").alias("min_magnitude"), F.max("magnitude").alias("max_magnitude"),
        F.min("origin_time").alias("earliest_origin"), F.max("origin_time").alias("latest_origin"),
    )


def create(store) -> list[str]:
    """Session views over the store's tables as they are now, and the reporting views over them [A26]."""
    from revisio.operators import revisions
    from revisio.plans import pipeline

    frames = {name: store.read(name) for name in store.tables}
    frames |= {
        "event_current": revisions.current(store.read("fact_event_revision")), "v_batch_health": pipeline.health(store),
        "v_receipt_window_audit": window_audit(store.read("batch_attempt")), "v_event_rejects": rejects(store.read("stg_event_revision")),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)


def load_state(plans: DataFrame, receipts: DataFrame, raw_counts: DataFrame) -> DataFrame:
    """ready, loaded or investigate for each planned attempt (attempt_id, expected_rows) [K23]."""
    r = receipts.groupBy("attempt_id").agg(F.count("*").alias("receipts"), F.min("load_status").alias("status"), F.min("loaded_rows").alias("loaded"))
    joined = plans.join(r, "attempt_id", "left").join(raw_counts, "attempt_id", "left").fillna(0, ["receipts", "raw_rows"])
    good = (F.col("receipts") == 1) & (F.col("status") == "complete") & (F.col("loaded") == F.col("raw_rows")) & (F.col("raw_rows") == F.col("expected_rows"))
    return joined.select("attempt_id", F.when((F.col("receipts") == 0) & (F.col("raw_rows") == 0), "ready").when(good, "loaded").otherwise("investigate").alias("load_state"))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Unit boundaries crossed between two instants [H6]; elapsed units would round down."""
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))
