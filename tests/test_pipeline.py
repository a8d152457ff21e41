"""State machine of attempts on the snapshot store, landing, and the HTTP source."""

import json
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from revisio.operators import revisions
from revisio.plans import pipeline
from revisio.plans.store import CommitConflict, Store
from revisio.sources import http, landing
from revisio.streaming import ingest

T0 = datetime(2026, 9, 1, tzinfo=UTC)


def feature(event="e1", updated=0, mag=1.08, status="automatic", geometry=True, ids=None):
    base = 1_780_000_000_000
    return {"id": event, "properties": {"time": base, "updated": base + updated * 1000, "status": status, "mag": mag, "ids": ids}, "geometry": {"type": "Point", "coordinates": [-122.3, 47.6, 1]} if geometry else None}


def capture(folder: Path, attempt: str, features, minute: int):
    at = T0 + timedelta(minutes=minute)
    manifest = http.publish(folder / attempt, "batch", attempt, [(f, "w0", at) for f in features], [{"window_id": "w0", "status": "reconciled"}])
    return {
        "attempt_id": attempt, "logical_batch_id": "batch", "batch_kind": "origin", "site_key": "seattle", "requested_starttime": T0, "requested_endtime": T0, "query_parameters": {}, "window_audit": manifest["window_audit"],
        "coverage_gaps": None, "fetched_at": at, "extract_status": "complete", "source_rows_returned": len(features), "raw_rows_written": len(features), "manifest": manifest,
    }


def land(store, folder, attempt, features, minute):
    landing.load(store, f"file://{folder}/{attempt}/events.jsonl", capture(folder, attempt, features, minute), T0 + timedelta(hours=1))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def now():
    return T0 + timedelta(hours=2)


def counts(store):
    return store.read("fact_event_revision").count(), store.read("bridge_event_site").count()


def test_lifecycle_rerun_failure_retry_clone(store, tmp_path):
    steps = [feature(), feature(updated=60, mag=1.28), feature(updated=120, status="deleted", geometry=False), feature()]
    seen = []
    for k, f in enumerate(steps):
        land(store, tmp_path, f"s{k}", [f], k)
        out = pipeline.process_attempt(store, f"s{k}", now=now)
        assert out.revision_rows_merged == 1
        magnitudes = [r.magnitude for r in revisions.current(store.read("fact_event_revision")).collect()]
        seen.append((*counts(store), magnitudes))
    assert seen == [(1, 3, [1.08]), (2, 6, [1.28]), (3, 9, []), (3, 9, [])]

    again = pipeline.process_attempt(store, "s3", now=now)
    assert again.revision_rows_merged == 0 and store.read("batch_process_attempt").count() == 5 and store.read("fact_batch_run").count() == 4
    version = store.version()
    assert store.read("fact_event_revision", 2).count() == 1  # the past: load, process, load, ...

    land(store, tmp_path, "s4", [feature("e9", ids=",e9,e1,")], 9)

    def broken(tx, rows, at):
        pipeline.write_models(tx, rows, at)
        raise RuntimeError("row text")

    with pytest.raises(RuntimeError):
        pipeline.process_attempt(store, "s4", writer=broken, now=now)
    assert counts(store) == (3, 9)
    failed = store.read("batch_process_attempt").where("status = 'failed'").first()
    assert failed.error_message == "Transformation failed" and pipeline.pending(store, 5) == ["s4"]
    other = store.clone(f"file://{tmp_path}/clone")
    pipeline.process_attempt(store, "s4", now=now)
    assert counts(store) == (4, 12) and counts(other) == (3, 9) and pipeline.pending(store, 5) == []
    assert {r.canonical_event_id for r in store.read("fact_event_revision").collect()} == {"e1"}
    assert store.vacuum() > 0 and counts(store) == (4, 12) and store.version() > version
    with pytest.raises(CommitConflict):
        store.clone(f"file://{tmp_path}/clone")
    other.drop()


def test_alias_rekey_moves_stored_keys(store, tmp_path):
    land(store, tmp_path, "a", [feature("m1"), feature("z1", updated=5)], 0)
    pipeline.process_attempt(store, "a", now=now)
    land(store, tmp_path, "b", [feature("m1", updated=9, ids=["m1", "a1"])], 1)
    pipeline.process_attempt(store, "b", now=now)
    assert sorted(r.canonical_event_id for r in store.read("fact_event_revision").collect()) == ["a1", "a1", "z1"]
    assert counts(store) == (3, 9)


def test_gates(store, tmp_path):
    receipt = capture(tmp_path, "g", [feature()], 0)
    with pytest.raises(ValueError, match="2 expected"):
        landing.load(store, f"file://{tmp_path}/g/events.jsonl", receipt | {"raw_rows_written": 2}, T0)
    landing.load(store, f"file://{tmp_path}/g/events.jsonl", receipt, T0)
    with pytest.raises(ValueError, match="already"):
        landing.load(store, f"file://{tmp_path}/g/events.jsonl", receipt, T0)
    with pytest.raises(ValueError, match="exactly one receipt"):
        pipeline.process_attempt(store, "none", now=now)
    assert store.read("batch_process_attempt").first().error_message == "expected exactly one receipt"


def test_watermark_and_races(store):
    first, second = store.transaction(), store.transaction()
    first.compare_and_set("watermark/all", None, "2026-01-01")
    second.compare_and_set("watermark/all", None, "2026-01-02")
    first.commit()
    with pytest.raises(CommitConflict):
        second.commit()
    with pytest.raises(CommitConflict):
        pipeline.commit_watermark(store, "all", None, "2026-01-03")
    pipeline.commit_watermark(store, "all", "2026-01-01", "2026-01-03")
    assert store.state("watermark/all") == "2026-01-03"
    with pytest.raises(ValueError):
        pipeline.commit_watermark(store, "all", "2026-01-03", "2025-01-01")


def test_stream_lands_each_attempt_once(store, tmp_path):
    receipts = {f"x{k}": capture(tmp_path / "land", f"x{k}", [feature(f"e{k}")], k) for k in range(3)}
    for _ in range(2):
        ingest.ingest(store, f"file://{tmp_path}/land", f"file://{tmp_path}/ck", lambda f: receipts[f.split("/")[-2]], lambda: T0).awaitTermination(120)
    assert store.read("raw_event_records").count() == 3 and store.read("batch_attempt").count() == 3


def transport_of(sizes, log):
    def answer(what, params):
        log.append((what, params["starttime"]))
        n = sizes(params)
        if what == "count":
            return http.Reply(200, json.dumps({"count": n}))
        return http.Reply(200, json.dumps({"type": "FeatureCollection", "features": [{"id": str(k)} for k in range(n)]}))

    return answer


def test_windows_split_and_reconcile():
    start, end = T0, T0 + timedelta(days=2)
    whole = (start.isoformat(), end.isoformat())
    client = http.Client(transport_of(lambda p: 20_000 if (p["starttime"], p["endtime"]) == whole else 2, []), sleep=lambda s: None)
    rows, audits = client.window({}, start, end)
    assert len(rows) == 4 and [a["status"] for a in audits] == ["split", "reconciled", "reconciled"]


def test_retry_gap_and_malformed():
    calls = iter([http.Reply(503), http.Reply(429, headers={"Retry-After": "1"}), http.Reply(200, "7")])
    waits = []
    assert http.Client(lambda w, p: next(calls), sleep=waits.append).count({}, 1e18) == 7 and waits[1] == 1.0
    with pytest.raises(http.SourceError):
        http.Client(lambda w, p: http.Reply(200, "{"), sleep=waits.append).features({}, 1e18)
    assert http.Client(lambda w, p: http.Reply(204), sleep=waits.append).features({}, 1e18) == []
    n = iter(range(10_000))
    rows, audits = http.Client(lambda w, p: http.Reply(200, json.dumps({"count": next(n)}) if w == "count" else '{"type": "FeatureCollection", "features": []}'), sleep=waits.append).window({}, T0, T0 + timedelta(microseconds=1))
    assert rows == [] and audits[0]["status"] == "unresolved"


def test_publish_and_checkpoint(tmp_path):
    gap = http.publish(tmp_path / "gap", "b", "gap", [({"id": "1"}, "w", T0)], [{"window_id": "w", "status": "unresolved"}])
    assert gap["status"] == "failed" and (tmp_path / "gap/events.jsonl").read_text() == ""
    http.save_checkpoint(tmp_path / "c.json", {"window": "w", "n": 1})
    assert http.load_checkpoint(tmp_path / "c.json", window="w")["n"] == 1 and http.load_checkpoint(tmp_path / "c.json", window="v") is None
    (tmp_path / "c.json").write_text((tmp_path / "c.json").read_text().replace('"n": 1', '"n": 2'))
    assert http.load_checkpoint(tmp_path / "c.json", window="w") is None
