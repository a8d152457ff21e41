"""Sweeps, re-keying stops, migration, inventory, briefs, pinned statements, the pending loop and torn commits."""

import json
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from revisio.operators import briefs, merge, revisions, sweeps, views, windows
from revisio.plans import checks, inventory, lineage, migrate, pipeline
from revisio.plans.store import CommitConflict, CommitUncertain, Store
from revisio.schema import REVISION_KEY
from revisio.sources import http, landing
from tests.test_pipeline import T0, capture, feature, land, now


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


# ---- commits
def test_a_torn_commit_leaves_the_store_readable(spark, store, tmp_path):
    """What a crash leaves beside the commits is no commit; a taken version is refused; an unanswered one is looked up."""
    first = store.version()
    (tmp_path / "store/commits" / f".{first + 1}-dead.tmp").write_text('{"tables"')
    assert store.version() == first and store.read("dim_site").count() == 0
    one, two = store.transaction(), store.transaction()
    one.compare_and_set("k", None, 1)
    one.commit()
    with pytest.raises(CommitConflict):
        two.commit()
    assert store.state("k") == 1 and not list((tmp_path / "store/commits").glob(f".{first + 1}-[!d]*.tmp"))

    tx, claim = store.transaction(), store._claim
    store._claim = lambda aside, target: claim(aside, target) and (_ for _ in ()).throw(OSError("no answer"))
    tx.compare_and_set("k", 1, 2)
    assert tx.commit() == store.version() and store.state("k") == 2  # it was published all the same
    tx = store.transaction()
    store._holds = lambda *a: (_ for _ in ()).throw(CommitUncertain("cannot be read"))
    with pytest.raises(CommitUncertain):
        tx.commit()


def test_an_uncertain_commit_is_not_logged(store, tmp_path, monkeypatch):
    land(store, tmp_path, "s0", [feature()], 0)
    monkeypatch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(CommitUncertain("?")))
    with pytest.raises(CommitUncertain):
        pipeline.process_attempt(store, "s0", now=now)
    monkeypatch.undo()
    assert store.read("batch_process_attempt").count() == 0


def test_metadata_temporary_tables_views_and_session(spark, store, tmp_path):
    land(store, tmp_path, "s0", [feature()], 0)
    pipeline.process_attempt(store, "s0", now=now)
    told = {r.table_name: r.written for r in store.metadata().collect()}
    assert told["raw_event_records"] and not told["update_watermark"] and len(told) == len(store.tables)
    store.temporary_like("dim_site", "sites_like")
    assert spark.table("sites_like").columns == store.read("dim_site").columns and spark.table("sites_like").count() == 0
    assert "v_batch_health" in views.create(store) and spark.sql("SELECT health_status FROM v_batch_health").first()[0] == "RECONCILED"
    assert spark.sql("SELECT count(*) FROM event_current").first()[0] == 1 and spark.sql("SELECT count(*) FROM v_event_rejects").first()[0] == 0
    statements = checks.reviewed(checks.UNIQUENESS, checks.UNIQUENESS_SHA256, ("fact_event_revision", "bridge_event_site"))
    assert all(spark.sql(s).count() == 0 for s in statements) and not checks.compile_only(spark, dict(enumerate(statements)))
    assert set(checks.compile_only(spark, {"bad": "SELECT nothing FROM nowhere", "good": "SELECT :x AS x"}, {"x": 1})) == {"bad"}
    with pytest.raises(ValueError, match="not the reviewed"):
        checks.reviewed(checks.UNIQUENESS + " ", checks.UNIQUENESS_SHA256)
    with pytest.raises(ValueError, match="other tables"):
        checks.reviewed(checks.UNIQUENESS, checks.UNIQUENESS_SHA256, ("bridge_event_site", "fact_event_revision"))
    assert checks.bound(spark, "SELECT ? + 1 AS y", [2]).first().y == 3
    assert lineage.configure(spark).conf.get("spark.sql.broadcastTimeout") == "600" and "variant_get" in lineage.functions_like(spark, "variant_g%")
    spark.sparkContext.setJobGroup("measured", "")
    spark.range(10).repartition(2).count()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert lineage.run_metrics(spark, "measured")["jobs"] >= 1


def test_tiers_and_counts(spark, store):
    """Segments of one level become one of the next; rows stay, and no write rewrites all."""
    for k in range(70):
        tx = store.transaction()
        tx.append("dim_magnitude_type", spark.createDataFrame([(f"m{k}",)], "magnitude_type string"))
        tx.commit()
    assert sorted(s["level"] for s in store.commit_at()["tables"]["dim_magnitude_type"]) == [0] * 6 + [2]
    rows = store.read("dim_magnitude_type")
    assert sorted(r.magnitude_type for r in rows.collect()) == sorted(f"m{k}" for k in range(70)) and store.read("dim_magnitude_type", 5).count() == 5
    assert merge.checked(rows, 70, "all").count() == 70 and merge.checked(rows, 1, "one", F.col("magnitude_type") == "m1") is rows
    with pytest.raises(merge.CountDiffers, match="70 rows instead of 3"):
        merge.checked(rows, 3, "all")


def test_merged_tables_hold_the_last_row_of_a_key(spark, store):
    of = lambda rows: spark.createDataFrame(rows, "source_event_id string, canonical_id string")
    want = {}
    for k in range(20):
        tx = store.transaction()
        rows = {f"s{j}": f"c{k}" for j in range(k % 5, k % 5 + 4)}
        if k % 3 == 2:
            gone = {f"s{j}" for j in range(k % 4, k % 4 + 3)}
            tx.exchange("alias_label", of([(s, None) for s in sorted(gone)]), of(sorted(rows.items())))
            want = {s: c for s, c in want.items() if s not in gone} | rows
        else:
            tx.append("alias_label", of(sorted(rows.items())))
            want |= rows
        tx.commit()
        assert {r.source_event_id: r.canonical_id for r in store.read("alias_label").collect()} == want
    assert len(store.commit_at()["tables"]["alias_label"]) < 10
    other = store.clone(store.root + "-clone")
    assert {r.source_event_id: r.canonical_id for r in other.read("alias_label").collect()} == want and store.vacuum() >= 0
    assert {r.source_event_id: r.canonical_id for r in store.read("alias_label").collect()} == want


def test_labels_added_step_by_step_equal_those_of_all(spark, store):
    """Random rows in ten attempts: stored labels are the components of all accepted rows so far."""
    import random

    from revisio.operators import aliases

    rng, seen = random.Random(5), []
    kind = "source_event_id string, associated_ids array<string>"
    for _ in range(10):
        rows = [(f"i{rng.randrange(40):02}", [f"i{rng.randrange(40):02}" for _ in range(rng.randrange(3))] if rng.random() < 0.5 else None) for _ in range(3)]
        seen += rows
        tx = store.transaction()
        changes, _ = aliases.added(tx.read("alias_label"), spark.createDataFrame(rows, kind))
        tx.append("alias_label", changes)
        tx.commit()
        assert sorted(map(tuple, store.read("alias_label").collect())) == sorted(map(tuple, aliases.canonical_ids(spark.createDataFrame(seen, kind)).collect()))


def test_an_attempt_writes_what_it_changes(store, tmp_path):
    """The bytes that an attempt adds do not grow with the table."""
    def size(names):
        return sum(f.stat().st_size for n in names for f in (tmp_path / "store" / n).glob("*.parquet"))

    land(store, tmp_path, "big", [feature(f"e{k}", k) for k in range(3000)], 0)
    pipeline.process_attempt(store, "big", now=now)
    whole = {t: size(x["rows"] for x in xs) for t, xs in store.commit_at()["tables"].items()}
    land(store, tmp_path, "small", [feature("e1", 9000), feature("new", ids=",new,e2,")], 1)
    before = {x.get(c) for xs in store.commit_at()["tables"].values() for x in xs for c in ("rows", "gone")}
    out = pipeline.process_attempt(store, "small", now=now)
    added = {t: [x[c] for x in xs for c in ("rows", "gone") if x.get(c) and x[c] not in before] for t, xs in store.commit_at()["tables"].items()}
    assert out.revision_rows_merged == 2 and all(size(added[t]) < 0.2 * whole[t] for t in ("fact_event_revision", "bridge_event_site", "alias_label", "stg_event_revision"))
    facts = store.read("fact_event_revision")
    assert facts.count() == 3002 and {r.canonical_event_id for r in facts.where("source_event_id in ('new', 'e2')").collect()} == {"e2"} and store.read("bridge_event_site").count() == 3 * 3002


# ---- the loop
def test_pending_loop_with_guards(store, tmp_path):
    for k in range(3):
        land(store, tmp_path, f"s{k}", [feature(f"e{k}"), feature(f"e{k}", mag="big")], k)
    done = pipeline.process_pending(store, 2, lambda s, a: pipeline.process_attempt(s, a, now=now))
    assert [o.attempt_id for o in done] == ["s0", "s1"] and [o.rejected_rows for o in done] == [1, 1] and pipeline.pending(store, 5) == ["s2"]
    with pytest.raises(pipeline.StateDiffers, match="another outcome"):
        pipeline.process_pending(store, 1, lambda s, a: done[0])
    with pytest.raises(ValueError):
        pipeline.process_pending(store, 0)
    pipeline.process_attempt(store, "s2", now=now)
    assert pipeline.process_pending(store, 5) == [] and {r.health_status for r in pipeline.health(store).collect()} == {"RECONCILED"}


def test_a_resolver_can_be_given(store, tmp_path, spark):
    land(store, tmp_path, "s0", [feature()], 0)
    resolve = lambda rows: rows.select("source_event_id", F.lit("one").alias("canonical_id")).distinct()
    pipeline.process_attempt(store, "s0", now=now, writer=lambda tx, staged, at: pipeline.write_models(tx, staged, at, resolve))
    assert [r.canonical_event_id for r in store.read("fact_event_revision").collect()] == ["one"]


# ---- re-keying
def facts_of(spark, rows):
    at = datetime(2026, 1, 1, tzinfo=UTC)
    return spark.createDataFrame([(c, at, h, s, at + timedelta(hours=n), "f", n) for c, h, s, n in rows], "canonical_event_id string, source_updated_at timestamp, payload_hash string, source_event_id string, fetched_at timestamp, stage_file_name string, stage_file_row_number bigint")


def bridges_of(facts, sites=("seattle", "san-francisco", "anchorage")):
    return facts.select(*REVISION_KEY).crossJoin(facts.sparkSession.createDataFrame([(s,) for s in sites], "site_key string"))


def test_rekey_stops(spark):
    good = facts_of(spark, [("a", "h", "a", 1), ("b", "h", "b", 2), ("c", "k", "c", 3)])
    to_a = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "source_event_id string, canonical_id string")
    kept, placed, moves = revisions.rekey_checked(good, bridges_of(good), to_a)
    assert moves == 1 and sorted((r.canonical_event_id, r.source_event_id) for r in kept.collect()) == [("a", "b"), ("c", "c")] and placed.count() == 6

    def problems(facts, bridges, mapping=to_a):
        found = {r.problem: r.n for r in revisions.rekey_problems(facts, bridges, mapping).collect()}
        if found:
            with pytest.raises(ValueError):
                revisions.rekey_checked(facts, bridges, mapping)
        return found

    assert problems(good, bridges_of(good)) == {}
    assert problems(good, bridges_of(good), to_a.where("source_event_id <> 'c'")) == {"no canonical id": 1, "bridge without a fact": 3}
    split = facts_of(spark, [("a", "h", "a", 1), ("a", "k", "b", 2)])
    assert problems(split, bridges_of(split), spark.createDataFrame([("a", "a"), ("b", "b")], "source_event_id string, canonical_id string")) == {"one id in two groups": 1}
    assert problems(good.union(good.where("source_event_id = 'c'")), bridges_of(good))["repeated fact key"] == 1
    assert problems(good, bridges_of(good).union(bridges_of(good, ("seattle",)).where("canonical_event_id = 'c'"))) == {"repeated bridge key": 1}
    assert problems(good, bridges_of(good).union(bridges_of(facts_of(spark, [("z", "h", "z", 1)]), ("seattle",)))) == {"bridge without a fact": 1}
    assert problems(good, bridges_of(good).where("NOT (canonical_event_id = 'b' AND site_key = 'seattle')")) == {"winner lacks a site": 1}
    assert problems(good.where("false"), bridges_of(good).where("false")) == {}


def test_conflicting_file_rows_are_refused(spark):
    rows = facts_of(spark, [("a", "h", "a", 1), ("b", "h", "b", 1)])
    with pytest.raises(ValueError, match="carries 2 revisions"):
        revisions.refuse_conflicts(rows)
    assert revisions.refuse_conflicts(rows.where("canonical_event_id = 'a'")).count() == 1


# ---- sweeps
LOW, CUT, MARK, START = (datetime(2026, m, 1, tzinfo=UTC) for m in (1, 5, 6, 7))


def sweep(folder, attempt="u0", mark=MARK, start=START, rows=3, **changed):
    plan = sweeps.plan(LOW, CUT, mark, start, 3600)
    middle = LOW + (CUT - LOW) / 2
    audits = [{"window_id": "w0", "status": "split", "starttime": LOW.isoformat(), "endtime": CUT.isoformat()}]
    audits += [{"window_id": f"w0.{k}", "status": "reconciled", "starttime": a.isoformat(), "endtime": b.isoformat(), "count_before": n, "returned_rows": n, "count_after": n} for k, (a, b, n) in enumerate([(LOW, middle, rows), (middle, CUT, 0)])]
    http.publish(folder / attempt, "batch", attempt, [(feature(f"e{k}"), "w0.0", start) for k in range(rows)], audits)
    manifest = json.loads((folder / attempt / "manifest.json").read_text()) | plan | {"batch_kind": "update_sweep"} | changed
    receipt = {"attempt_id": attempt, "logical_batch_id": "batch", "batch_kind": "update_sweep", "window_audit": manifest["window_audit"], "coverage_gaps": None, "fetched_at": start, "extract_status": "complete", "source_rows_returned": rows, "raw_rows_written": rows, "manifest": manifest}
    return f"file://{folder}/{attempt}/events.jsonl", manifest, receipt


def test_sweep_moves_the_watermark_once(store, tmp_path):
    path, manifest, receipt = sweep(tmp_path)
    with pytest.raises(ValueError, match="initial watermark"):
        sweeps.load_and_commit(store, path, manifest, receipt)
    with pytest.raises(ValueError, match="stale"):
        sweeps.load_and_commit(store, path, manifest, receipt, initial_watermark=LOW.isoformat())
    value = sweeps.load_and_commit(store, path, manifest, receipt, initial_watermark=MARK.isoformat())
    assert value["committed_watermark"] == START.isoformat() and store.state("sweep/updates") == value and store.read("raw_event_records").count() == 3
    with pytest.raises(ValueError, match="stale"):
        sweeps.load_and_commit(store, path, manifest, receipt)
    later = START + timedelta(days=30)
    path, manifest, receipt = sweep(tmp_path, "u1", START, later, 2)
    landing.load(store, path, receipt, later)  # a run that stopped after its load is only checked
    assert sweeps.load_and_commit(store, path, manifest, receipt)["previous_watermark"] == START.isoformat() and store.read("raw_event_records").count() == 5
    for name, value in (("catalog_lower_bound", (LOW - timedelta(days=1)).isoformat()), ("origin_time_cutoff", (CUT - timedelta(days=1)).isoformat())):
        path, manifest, receipt = sweep(tmp_path, f"x-{name}", later, later + timedelta(days=1))
        with pytest.raises(ValueError):
            sweeps.load_and_commit(store, path, manifest | {name: value}, receipt)


@pytest.mark.parametrize("name,changed,why", [
    ("kind", {"batch_kind": "origin"}, "complete update sweep"), ("gaps", {"coverage_gaps": [1]}, "complete update sweep"), ("parameters", {"query_parameters": {}}, "query_parameters"), ("mark", {"proposed_watermark_after_success": "x"}, "proposed"),
])
def test_sweeps_that_are_refused(store, tmp_path, name, changed, why):
    path, manifest, receipt = sweep(tmp_path, name, **changed)
    with pytest.raises(ValueError, match=why):
        sweeps.load_and_commit(store, path, manifest, receipt, initial_watermark=MARK.isoformat())


def test_sweep_audits_that_are_refused(store, tmp_path):
    path, manifest, _ = sweep(tmp_path)
    rows = landing.scan(store.spark, path)
    sweeps.validate(store, manifest, rows)

    def changed(k, **fields):
        return manifest | {"window_audit": [a | fields if i == k else a for i, a in enumerate(manifest["window_audit"])]}

    for bad, why in (
        (changed(2, status="unresolved"), "unsettled"), (changed(2, starttime=LOW.isoformat()), "range"), (changed(2, endtime=(CUT + timedelta(days=1)).isoformat()), "range"), (changed(1, count_after=4), "counts"),
        (changed(2, window_id="w0.0"), "counts"), (changed(2, count_before=1, returned_rows=1, count_after=1), "rows differ"), (changed(1, window_id="other"), "rows differ"), (manifest | {"window_audit": []}, "unsettled"),
    ):
        with pytest.raises(ValueError, match=why):
            sweeps.validate(store, bad, rows)


# ---- landing and the source
def test_staging_is_exclusive(store, tmp_path):
    capture(tmp_path, "s0", [feature()], 0)
    target = landing.stage(store, f"file://{tmp_path}/s0/events.jsonl", "s0")
    assert landing.scan(store.spark, target).count() == 1
    with pytest.raises(FileExistsError):
        landing.stage(store, f"file://{tmp_path}/s0/events.jsonl", "s0")
    with pytest.raises(ValueError):
        landing.stage(store, f"file://{tmp_path}/s0/events.jsonl", "../s0")


def answers(script):
    """A transport that answers counts and queries from script(kind, params)."""
    return lambda what, params: script(what, params)


def body(n):
    return json.dumps({"type": "FeatureCollection", "features": [feature(f"e{k}") for k in range(n)]})


def client(script):
    return http.Client(answers(script), sleep=lambda s: None)


A, B = datetime(2026, 1, 1, tzinfo=UTC), datetime(2026, 1, 3, tzinfo=UTC)


def test_a_full_window_is_split():
    def script(what, params):
        whole = params["starttime"] == A.isoformat() and params["endtime"] == B.isoformat()
        n = http.SAFE_ROWS if whole else 1
        return http.Reply(200, json.dumps({"count": n}) if what == "count" else body(n))

    rows, audits = client(script).window({}, A, B)
    assert len(rows) == 2 and [a["status"] for a in audits] == ["split", "reconciled", "reconciled"] and audits[0]["reason"] == "too many rows"


def test_timeouts_split_and_errors_are_gaps():
    def slow(what, params):
        if (datetime.fromisoformat(params["endtime"]) - datetime.fromisoformat(params["starttime"])) > timedelta(hours=13):
            raise TimeoutError("slow")
        return http.Reply(200, json.dumps({"count": 1}) if what == "count" else body(1))

    rows, audits = client(slow).window({}, A, B)
    assert len(rows) == 4 and sum(a["status"] == "split" for a in audits) == 3
    rows, audits = client(lambda w, p: (_ for _ in ()).throw(TimeoutError("never"))).window({}, A, B)
    assert not rows and sum(a["status"] == "unresolved" for a in audits) == 2**http.TIMEOUT_DEPTH
    rows, audits = client(lambda w, p: http.Reply(400, "no")).window({}, A, B)
    assert not rows and [a["status"] for a in audits] == ["unresolved"] and audits[0]["reason"]


def test_manifests_run_then_complete(tmp_path):
    http.begin(tmp_path / "s0", "batch", "s0", site_key="seattle")
    assert json.loads((tmp_path / "s0/manifest.json").read_text())["status"] == "running"
    with pytest.raises(FileExistsError):
        http.begin(tmp_path / "s0", "batch", "s0")
    with pytest.raises(FileExistsError):
        http.publish(tmp_path / "s0", "batch", "other", [], [])
    http.publish(tmp_path / "s0", "batch", "s0", [(feature(), "w0", T0)], [], site_key="seattle")
    told = json.loads((tmp_path / "s0/manifest.json").read_text())
    assert told["status"] == "complete" and told["site_key"] == "seattle"
    with pytest.raises(FileExistsError):
        http.publish(tmp_path / "s0", "batch", "s0", [], [])


def test_checkpoints_of_earlier_attempts(tmp_path):
    audit = {"window_id": "w0", "status": "reconciled", "starttime": A.isoformat(), "endtime": B.isoformat(), "count_before": 1, "returned_rows": 1, "count_after": 1}
    good = {"params": {"k": "v"}, "starttime": A.isoformat(), "endtime": B.isoformat(), "window_audit": [audit], "rows": [{"window_id": "w0", "fetched_at": B.isoformat()}], "fetched_at": B.isoformat()}
    find = lambda: http.child_capture(tmp_path, {"k": "v"}, A, B)
    assert find() is None
    bad = [
        good | {"params": {}}, good | {"rows": []}, good | {"fetched_at": "2026-01-03T00:00:00"}, good | {"window_audit": [audit | {"count_after": 2}]}, good | {"window_audit": [audit | {"status": "unresolved"}]},
        good | {"window_audit": [audit | {"endtime": A.isoformat()}]}, good | {"window_audit": []}, good | {"rows": [{"window_id": "w0", "fetched_at": "2026-01-03"}]}, good | {"window_audit": [{}]},
    ]
    for k, payload in enumerate(bad):
        os.makedirs(tmp_path / f"old{k}")
        http.save_checkpoint(tmp_path / f"old{k}/c.checkpoint.json", payload)
    assert find() is None
    http.save_checkpoint(tmp_path / "old0/d.checkpoint.json", good)
    later = good | {"fetched_at": (B + timedelta(hours=1)).isoformat()}
    http.save_checkpoint(tmp_path / "old1/d.checkpoint.json", later)
    assert find() == later


# ---- migration, inventory
def test_migration(store, tmp_path, spark):
    stub = {"id": "e9", "properties": {"time": None, "mag": None, "status": None}, "geometry": None}
    land(store, tmp_path, "s0", [feature(), stub], 0)
    pipeline.process_attempt(store, "s0", now=now)
    tx = store.transaction()
    tx.replace("stg_event_revision", store.read("stg_event_revision").withColumns({"staging_parser_version": F.lit("1"), "reject_reason": F.when(F.col("reject_reason").isNotNull(), "invalid_origin_time")}))
    tx.replace("fact_event_revision", store.read("fact_event_revision").withColumn("staging_parser_version", F.lit("1")))
    tx.commit()
    how = {"old_version": "1", "new_version": "2", "old_reason": "invalid_origin_time", "new_reason": "source_stub_record", "expected": {("1", None): 1, ("1", "invalid_origin_time"): 1}}
    with pytest.raises(ValueError, match="not the expected"):
        migrate.migrate(store, **how | {"expected": {("1", None): 2}})
    assert migrate.migrate(store, **how) == "relabelled 1 of 2 staging rows"
    assert migrate.state(store.read("stg_event_revision")) == {("2", None): 1, ("2", "source_stub_record"): 1} and store.read("fact_event_revision").first().staging_parser_version == "2"
    version = store.version()
    assert migrate.migrate(store, **how) == "migrated already" and store.version() == version


def test_inventory_and_resume(spark, tmp_path):
    cut = datetime(2026, 9, 29, tzinfo=UTC)
    planned = windows.history_windows(spark, cut)
    first = planned.orderBy("window_no").limit(3).collect()
    for k, (r, status, gaps) in enumerate(zip(first, ("complete", "failed", "complete"), ([], [], [1]), strict=True)):
        os.makedirs(tmp_path / f"m{k}")
        (tmp_path / f"m{k}/manifest.json").write_text(json.dumps({"site_key": r.site_key, "requested_starttime": r.window_start.isoformat(), "requested_endtime": r.window_end.isoformat(), "status": status, "coverage_gaps": gaps}))
    os.makedirs(tmp_path / "broken")
    (tmp_path / "broken/manifest.json").write_text("{")
    folder = f"file://{tmp_path}"
    assert {r.window_no for r in inventory.captured(planned, inventory.manifests(spark, folder)).where("captures > 0").collect()} == {1}
    assert inventory.resume(spark, cut, folder, 2, None) == [2, 3] and inventory.resume(spark, cut, None, 1, None, first=180) == [180]
    seen = []
    run = lambda site, start, end, **kw: seen.append((site, kw["hours"])) or {"status": "complete" if len(seen) < 2 else "failed"}
    with pytest.raises(RuntimeError, match="window 3"):
        inventory.resume(spark, cut, folder, 5, run, days=1, hours=6)
    assert seen == [("seattle", 6)] * 2
    for wrong in ({"most": 0}, {"most": 61}, {"first": 181}, {"days": 8}, {"hours": 3}, {"days": 2, "hours": 3}, {"days": 1, "hours": 13}):
        with pytest.raises(ValueError):
            inventory.resume(spark, cut, folder, wrong.pop("most", 1), None, **wrong)


# ---- briefs
def test_briefs_cache_and_one_retry(spark, tmp_path):
    cases = spark.createDataFrame([("c1", "seattle", 250.0, 1, 3, "u1", 12.5, 4.25, "reviewed", 7.0), ("c2", "anchorage", 250.0, 1, 1, "u2", 3.0, 1.0, "automatic", 2.5)],
        "case_id string, site_key string, radius_km double, distinct_radii bigint, event_count bigint, nearest_event_id string, nearest_distance_km double, nearest_magnitude double, nearest_source_status string, nearest_record_age_hours double")
    cache = briefs.Cache(tmp_path / "b/cache.json", "template")
    asked = []

    def complete(prompt):
        asked.append(prompt)
        if "anchorage" in prompt.lower():
            raise RuntimeError("down")
        return "Nothing of use, and a danger"

    out = {r.case_id: r for r in briefs.write_briefs(cases, cache, complete).collect()}
    assert out["c2"].status == "error" and out["c1"].status == "rejected" and {"hazard or action language", "incomplete ending", "missing or misstated radius"} <= set(out["c1"].problems)
    assert len(asked) == 2 and "12.5 km from Seattle" in asked[0]
    cache = briefs.Cache(tmp_path / "b/cache.json", "template")
    out = {r.case_id: r for r in briefs.write_briefs(cases, cache, complete).collect()}
    assert len(asked) == 2 and out["c1"].status == "rejected"  # nothing is asked twice
    out = {r.case_id: r for r in briefs.write_briefs(cases, cache, None, retry=["c1", "c2"]).collect()}
    assert out["c1"].status == out["c2"].status == "accepted" and out["c1"].problems == []
    with pytest.raises(ValueError, match="no retry"):
        briefs.write_briefs(cases, cache, None, retry=["c1"])
    changed = cases.withColumn("event_count", F.col("event_count") + 1)
    assert {r.status for r in briefs.write_briefs(changed, cache).collect()} == {"accepted"} and len(cache.results) == 4
    with pytest.raises(ValueError, match="another model"):
        briefs.Cache(tmp_path / "b/cache.json", "other")
    assert briefs.aggregate_problems(cases, ["c1", "c2"]).count() == 0


def test_sweep_windows_from_their_rule():
    utc = lambda *a: datetime(*a, tzinfo=UTC)
    out = windows.sweep_windows(utc(1950, 1, 1), utc(2026, 3, 10), 20, 2001, 5, 2025, 2, "2026-01")
    assert out[0] == (utc(1950, 1, 1), utc(1970, 1, 1)) and out[2] == (utc(1990, 1, 1), utc(2001, 1, 1)) and out[3] == (utc(2001, 1, 1), utc(2006, 1, 1))
    assert all(b == c for (_, b), (c, _) in zip(out, out[1:], strict=False)) and out[-1][1] == utc(2026, 3, 10)
    days = [w for w in out if w[1] - w[0] == timedelta(days=1)]
    assert days[0][0] == utc(2026, 1, 1) and len(days) == 31 and (utc(2026, 2, 1), utc(2026, 3, 10)) == out[-1]
    assert windows.sweep_windows(utc(9998, 1, 1), utc(9999, 12, 31), 50)[-1][1] == utc(9999, 12, 31)
