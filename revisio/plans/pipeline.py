"""From loaded receipts to models, in one commit per attempt [J1, K2, K3, K6, K12-K14, K29, L1-L5]."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisio.functions import geo, project
from revisio.operators import aliases, merge, revisions, views
from revisio.plans.lineage import Scratch
from revisio.plans.store import CommitUncertain, Store, Transaction
from revisio.schema import FILE_ROW, REVISION_KEY, STAGING_PARSER_VERSION


@dataclass(frozen=True)
class Outcome:
    """One processing attempt; its shape is checked before it is logged [K13]."""

    process_attempt_id: str
    attempt_id: str
    started_at: datetime
    finished_at: datetime
    status: str
    loaded_rows: int = 0
    processed_rows: int = 0
    rejected_rows: int = 0
    revision_rows_merged: int = 0
    error_type: str | None = None
    error_message: str | None = None

    def check(self) -> None:
        if self.status not in ("complete", "failed") or self.started_at.tzinfo is None or self.finished_at < self.started_at:
            raise ValueError("invalid status or times")
        if not 0 <= self.rejected_rows <= self.processed_rows <= self.loaded_rows or self.revision_rows_merged < 0:
            raise ValueError("invalid row counts")
        failed = self.status == "failed"
        if failed != bool(self.error_type) or failed != bool(self.error_message) or failed and self.revision_rows_merged:
            raise ValueError("invalid error fields")


class ModelWriter(Protocol):
    def __call__(self, tx: Transaction, staged: DataFrame, at: datetime) -> int: ...


#: Accepted staging rows of all attempts to (source_event_id, canonical_id) [J3].
Resolver = Callable[[DataFrame], DataFrame]


def receipt_gate(store: Store, attempt_id: str) -> dict:
    """The one complete receipt without gaps whose three counts agree [K3]."""
    rows = store.read("batch_attempt").where(F.col("attempt_id") == attempt_id).select("*", F.to_json("coverage_gaps").alias("gaps")).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one receipt")
    r = rows[0].asDict()
    counts = {r["source_rows_returned"], r["raw_rows_written"], r["loaded_rows"]}
    if (r["extract_status"], r["load_status"]) != ("complete", "complete") or r["gaps"] not in (None, "[]", "null") or len(counts) != 1 or min(counts) < 0:
        raise ValueError("the receipt is not complete and reconciled")
    return r


def projected(store: Store, attempt_id: str, receipt: dict, at: datetime) -> tuple[DataFrame, int, int]:
    """(typed rows, processed, rejected) of an attempt, after its contract is checked in one aggregate [K1, K2]."""
    raw = store.read("raw_event_records").where(F.col("attempt_id") == attempt_id)
    rows = project.project(raw.withColumnRenamed("parser_version", "raw_parser_version")).withColumn("projected_at", F.lit(at))
    rows = Scratch(store.spark, "projected").cut(rows.drop("payload"), "rows")  # the models read the typed rows many times
    lacking = F.greatest(*(F.col(c).isNull() for c in ("window_id", "fetched_at", "payload_hash", "raw_parser_version", *FILE_ROW)), F.coalesce(F.col("stage_file_row_number") < 1, F.lit(True)))
    n, bad, keys, rejected = rows.agg(F.count("*"), F.count_if(lacking), F.count_distinct(*FILE_ROW), F.count_if(F.col("reject_reason").isNotNull())).first()
    if bad or keys != n:
        raise ValueError(f"{bad} rows lack capture metadata; {n - keys} repeat a file row")
    if n != receipt["loaded_rows"]:
        raise ValueError(f"{n} rows instead of {receipt['loaded_rows']}")
    return rows, n, rejected


def write_models(tx: Transaction, staged: DataFrame, at: datetime, resolve: Resolver | None = None) -> int:
    """Staging, aliases, rekey, facts, dimensions, bridge; returns revisions inserted or updated.

    What is written is what an attempt adds or changes, whatever the tables hold; past edges of
    aliases are not read again. resolve: another way to canonical ids, from all accepted rows.
    """
    scratch = Scratch(staged.sparkSession, "models")
    target = tx.read("stg_event_revision")
    clash = staged.join(target.select(*FILE_ROW, *(F.col(c).alias(f"old_{c}") for c in ("attempt_id", "payload_hash", "raw_parser_version", "staging_parser_version"))), list(FILE_ROW))
    if clash.where(" OR ".join(f"{c} <> old_{c}" for c in ("attempt_id", "payload_hash", "raw_parser_version", "staging_parser_version"))).limit(1).count():
        raise ValueError("stored staging rows differ")
    tx.append("stg_event_revision", merge.insert_only(target, staged, FILE_ROW))
    staged_counts = staged.groupBy("attempt_id").agg(F.count("*").alias("processed"))
    stored_counts = tx.read("stg_event_revision").join(F.broadcast(staged_counts.select("attempt_id")), "attempt_id", "left_semi").groupBy("attempt_id").agg(F.count("*").alias("stored"))
    if staged_counts.join(stored_counts, "attempt_id", "left").where(~F.col("processed").eqNullSafe(F.col("stored"))).limit(1).count():
        raise ValueError("staging holds another number of rows than were processed")

    valid = staged.where("reject_reason IS NULL")
    labels = tx.read("alias_label")
    if resolve is None:
        changes, moved = aliases.added(labels, valid)
    else:
        wanted = scratch.cut(resolve(tx.read("stg_event_revision").where("reject_reason IS NULL")), "wanted")
        both = wanted.join(labels.withColumnRenamed("canonical_id", "old_id"), "source_event_id", "left").where(~F.col("canonical_id").eqNullSafe(F.col("old_id")))
        changes, moved = both.select("source_event_id", "canonical_id"), both.where("old_id IS NOT NULL").select("old_id", F.col("canonical_id").alias("new_id")).distinct()
    tx.append("alias_label", scratch.cut(changes, "labels"))
    labels = tx.read("alias_label")
    moved = scratch.cut(moved, "moved")
    if not moved.isEmpty():
        _rekey(tx, moved, labels, scratch)

    ids = valid.select("source_event_id").distinct()
    labels = tx.read("alias_label", matching=ids)
    names = ids.join(labels.withColumnRenamed("canonical_id", "canonical_event_id"), "source_event_id", "left")
    accepted = valid.join(names, "source_event_id", "left")
    accepted = accepted.withColumn("canonical_event_id", F.coalesce("canonical_event_id", F.raise_error(F.lit("no canonical id")).cast("string"))).withColumn("curated_at", F.lit(at))
    source = scratch.cut(revisions.dedup(revisions.refuse_conflicts(accepted.select(*tx.read("fact_event_revision").columns))), "source")
    stored = tx.read("fact_event_revision", matching=source.select(*REVISION_KEY))
    lineage = ["fetched_at", "curated_at", "stage_file_name", "stage_file_row_number"]
    merged = scratch.cut(merge.upsert(stored, source, REVISION_KEY, lineage, F.col("s.fetched_at") > F.col("t.fetched_at")).where("merge_action <> 'kept'"), "merged")  # once, for the table, its check and the count
    changed = merged.count()
    if duplicates := revisions.duplicate_groups(merged, REVISION_KEY):
        raise ValueError(f"{duplicates} revision keys repeat after the merge")
    if changed:
        tx.append("fact_event_revision", merged)

    placed = scratch.cut(geo.bridge(source.select(*REVISION_KEY, "latitude", "longitude")), "bridge")
    if duplicates := revisions.duplicate_groups(placed, (*REVISION_KEY, "site_key")):
        raise ValueError(f"{duplicates} bridge keys repeat after the merge")
    if not placed.isEmpty():
        tx.append("bridge_event_site", placed)
    days = source.select(F.explode(F.array("origin_time", "source_updated_at")).alias("t")).select(F.to_date("t").alias("date_key")).distinct().select("date_key", F.year("date_key").alias("calendar_year"), F.month("date_key").alias("calendar_month"))
    dims = {
        "dim_date": (days, ["date_key"]), "dim_magnitude_type": (source.select("magnitude_type").where("magnitude_type IS NOT NULL").distinct(), ["magnitude_type"]),
        "dim_event_status": (source.select("source_status").distinct(), ["source_status"]),
        "dim_site": (geo.sites(staged.sparkSession).select("site_key", "site_name", F.col("site_latitude").alias("latitude"), F.col("site_longitude").alias("longitude"), "radius_km"), ["site_key"]),
    }
    for table, (rows, keys) in dims.items():
        rows = scratch.cut(merge.insert_only(tx.read(table), rows, keys), table)
        if not rows.isEmpty():
            tx.append(table, rows)
    scratch.drop("labels", "moved", "source", "merged", "bridge", *dims)
    return changed


def _rekey(tx: Transaction, moved: DataFrame, labels: DataFrame, scratch: Scratch) -> None:
    """Facts and bridges of the canonical ids that move, and of those they may meet, under their new ids [K7]."""
    touched = moved.select(F.explode(F.array("old_id", "new_id")).alias("canonical_event_id")).distinct()
    facts = scratch.cut(tx.read("fact_event_revision", matching=touched), "facts-touched")
    bridges = scratch.cut(tx.read("bridge_event_site", matching=touched), "bridges-touched")
    canonical = scratch.cut(labels.join(facts.select("source_event_id").distinct(), "source_event_id", "left_semi"), "ids-touched")
    new_facts, new_bridges, _ = revisions.rekey_checked(facts, bridges, canonical)
    tx.exchange("fact_event_revision", facts, scratch.cut(new_facts, "facts-new"))
    tx.exchange("bridge_event_site", bridges, scratch.cut(new_bridges, "bridges-new"))
    scratch.drop("facts-touched", "bridges-touched", "ids-touched", "facts-new", "bridges-new")


def process_attempt(store: Store, attempt_id: str, *, writer: ModelWriter = write_models, make_id: Callable[[], str] = lambda: uuid.uuid4().hex, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> Outcome:
    """Models and success log in one commit; on failure nothing of it, and a failure record in a commit of its own [K14].

    Only messages of ValueError are stored; others may hold data. A commit that may be visible
    is no failure: CommitUncertain is raised and nothing is logged.
    """
    process_id, started = make_id(), now()
    n = processed = rejected = 0
    try:
        receipt = receipt_gate(store, attempt_id)
        rows, processed, rejected = projected(store, attempt_id, receipt, started)
        n = receipt["loaded_rows"]
        tx = store.transaction()
        changed = writer(tx, rows, started)
        outcome = Outcome(process_id, attempt_id, started, now(), "complete", n, processed, rejected, changed)
        _batch_fact(tx, receipt, outcome)
        _log(tx, outcome)
        tx.commit()
        return outcome
    except CommitUncertain:
        raise
    except Exception as error:
        message = str(error) if isinstance(error, ValueError) else "Transformation failed"
        failed = Outcome(process_id, attempt_id, started, now(), "failed", n, processed, rejected, 0, type(error).__name__, message)
        tx = store.transaction()
        _log(tx, failed)
        tx.commit()
        raise


def _log(tx: Transaction, outcome: Outcome) -> None:
    outcome.check()
    log = tx.read("batch_process_attempt")
    if log.where(F.col("process_attempt_id") == outcome.process_attempt_id).limit(1).count():
        raise ValueError("the process attempt is logged already")
    kinds = {f.name: f.dataType.simpleString() for f in log.schema}
    row = asdict(outcome) | {"staging_parser_version": STAGING_PARSER_VERSION, "recorded_at": outcome.finished_at}
    tx.append("batch_process_attempt", log.sparkSession.range(1).select(*(F.lit(row[c]).cast(k).alias(c) for c, k in kinds.items())))


def _batch_fact(tx: Transaction, receipt: dict, outcome: Outcome) -> None:
    """The success record of an attempt [K12]; on a rerun seven measures change."""
    target = tx.read("fact_batch_run")
    fetched = receipt["fetched_at"]
    seconds = None if fetched is None else round((outcome.finished_at.replace(tzinfo=None) - fetched.replace(tzinfo=None)).total_seconds(), 3)
    if seconds is not None and seconds < 0:
        raise ValueError("curated before it was fetched")
    row = {c: receipt.get(c) for c in target.columns} | {
        "raw_recorded_at": receipt["recorded_at"], "curated_at": outcome.finished_at, "processed_rows": outcome.processed_rows, "rejected_rows": outcome.rejected_rows,
        "fetch_to_curated_seconds": seconds, "process_status": "complete", "last_process_attempt_id": outcome.process_attempt_id, "coverage_gaps": None, "reconciliation_ok": True, "updated_at": outcome.finished_at,
    }
    source = target.sparkSession.range(1).select(*(F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in target.schema))
    changing = ["curated_at", "processed_rows", "rejected_rows", "fetch_to_curated_seconds", "process_status", "last_process_attempt_id", "updated_at"]
    stored = target.where(F.col("attempt_id") == row["attempt_id"])
    tx.append("fact_batch_run", merge.upsert(stored, source, ["attempt_id"], changing))


def commit_watermark(store: Store, sweep: str, expected: str | None, value: str) -> int:
    """Advance a sweep's watermark, or raise if it is not what was read [I6, L7]. ISO instants in UTC."""
    if expected is not None and value < expected:
        raise ValueError("a watermark does not go back")
    tx = store.transaction()
    tx.compare_and_set(f"watermark/{sweep}", expected, value)
    return tx.commit()


def pending(store: Store, limit: int) -> list[str]:
    """Loaded attempts without a success, oldest fetch first; the queue's bound is 1 to 200 [F2, K24]."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    done = store.read("batch_process_attempt").where("status = 'complete'").select("attempt_id")
    rows = store.read("batch_attempt").where("load_status = 'complete'").join(done, "attempt_id", "left_anti").orderBy("fetched_at", "attempt_id").select("attempt_id").limit(limit)
    return [r.attempt_id for r in rows.collect()]


class StateDiffers(RuntimeError):
    """An attempt is not in the state that was expected; the loop stops there."""


def health(store: Store, attempt_id: str | None = None) -> DataFrame:
    """Batch health over the store's tables [K15], of one attempt or of all."""
    one = lambda table: store.read(table) if attempt_id is None else store.read(table).where(F.col("attempt_id") == attempt_id)
    raw = one("raw_event_records").groupBy("attempt_id").agg(F.count("*").alias("raw_rows"))
    staged = one("stg_event_revision").groupBy("attempt_id").agg(F.count("*").alias("staging_rows"), F.count_if(F.col("reject_reason").isNotNull()).alias("staging_reject_rows"))
    gaps = F.coalesce(F.size(F.try_variant_get("coverage_gaps", "$", "array<variant>")), F.lit(0))
    receipts = one("batch_attempt").withColumn("gap_count", F.when(F.col("coverage_gaps").isNull(), 0).otherwise(F.greatest(gaps, F.lit(0))))
    return views.batch_health(receipts, raw, staged, one("batch_process_attempt"), one("fact_batch_run"), F.col("gap_count"))


def process_pending(store: Store, limit: int, run: Callable[[Store, str], Outcome] = process_attempt) -> list[Outcome]:
    """Process the oldest pending attempts; before and after each its health must be what the loop expects [K24]."""
    done = []
    for attempt_id in pending(store, limit):
        state = lambda: [(r.health_status, r.loaded_rows, r.raw_rows, r.staging_rows, r.processed_rows, r.rejected_rows) for r in health(store, attempt_id).collect()]  # noqa: E731, B023
        before = state()
        n = before[0][1] if before else None
        if before != [("PENDING_PROCESS", n, n, 0, None, None)]:
            raise StateDiffers(f"{attempt_id} is not pending as it was: {before}")
        outcome = run(store, attempt_id)
        if (outcome.attempt_id, outcome.status, outcome.loaded_rows, outcome.processed_rows) != (attempt_id, "complete", n, n) or not outcome.process_attempt_id:
            raise StateDiffers(f"{attempt_id} was processed with another outcome: {outcome}")
        if (after := state()) != [("RECONCILED", n, n, n, n, outcome.rejected_rows)]:
            raise StateDiffers(f"{attempt_id} is not reconciled: {after}")
        done.append(outcome)
    return done
