"""Operators that deal their work out, against brute force and with their edges."""

import math
import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from revisio.functions import geo, grid
from revisio.operators import briefs, distinct, intervals, revisions, selection, sweeps, windows
from revisio.plans import checks, registry
from revisio.sources import landing
from revisio.streaming import current, health

T0 = datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


def scans(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


# ---- percentiles [D6]


def test_percentiles_of_ties_heavy_tails_and_empty_groups(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.lognormal(0, 8, 3000), np.full(2000, 3.5), -rng.random(500)])
    rows = [("a", float(x)) for x in values] + [("b", float(x)) for x in range(7)] + [("c", None), (None, 2.0), (None, 1.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    fractions = [0, 0.31, 0.5, 0.95, 1]
    for small, buckets in ((4096, 64), (300, 16)):
        got = {r.g: r for r in selection.percentiles(frame, "v", fractions, ["g"], small=small, buckets=buckets).collect()}
        for g in ("a", "b", None):
            own = [v for k, v in rows if k == g]
            assert got[g].n == len(own) and got[g].least == min(own) and got[g].most == max(own)
            assert np.allclose([got[g][f"p{p * 100:g}"] for p in fractions], np.percentile(own, [100 * p for p in fractions]), rtol=1e-12)
        assert tuple(got["c"])[1:] == (0, *[None] * 7)


def test_percentiles_of_nothing_and_of_what_is_no_number(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),), (math.inf,), (-math.inf,)], "v double")
    row = selection.percentiles(frame, "v", [0, 0.5, 1], names=["low", "middle", "high"]).first()
    assert row.low == -math.inf and row.middle == math.inf and math.isnan(row.high)  # halfway between 1 and infinity
    assert tuple(selection.percentiles(frame.limit(0), "v", [0.5]).first()) == (0, None, None, None)
    with pytest.raises(ValueError, match="groups"):
        selection.percentiles(spark.range(5).withColumn("v", F.lit(1.0)), "v", [0.5], ["id"], groups_at_most=4)


# ---- one pass over shared inputs [K7, K26, I7]


def test_checks_read_each_input_once(spark):
    assert scans(registry.QUERIES["rekey_stops"](spark, SF)) <= 3
    assert scans(registry.QUERIES["sweep_coverage"](spark, SF)) <= 3


def test_all_seven_problems_are_counted(spark):
    at = datetime(2024, 1, 1)
    fact = lambda i, s, file="f", row=1, h="h": (i, at, h, s, at, file, row)
    facts = [fact("a", "s1"), fact("b", "s2", row=2), fact("c", "s3"), fact("c", "s3"), fact("d", "s4"), fact("d", "s5", h="k"), fact("e", "none")]
    columns = "canonical_event_id string, source_updated_at timestamp, payload_hash string, source_event_id string, fetched_at timestamp, stage_file_name string, stage_file_row_number bigint"
    canonical = spark.createDataFrame([("s1", "x"), ("s2", "x"), ("s3", "y"), ("s4", "z1"), ("s5", "z2")], "source_event_id string, canonical_id string")
    bridges = [("b", at, "h", "seattle"), ("b", at, "h", "seattle"), ("a", at, "h", "anchorage"), ("q", at, "h", "seattle"), ("q", at, "h", "anchorage"), ("e", at, "h", None)]
    found = revisions.rekey_problems(spark.createDataFrame(facts, columns), spark.createDataFrame(bridges, "canonical_event_id string, source_updated_at timestamp, payload_hash string, site_key string"), canonical)
    got = {r.problem: r.n for r in found.collect()}
    assert got == {"no canonical id": 1, "one id in two groups": 1, "repeated fact key": 1, "bridge without a fact": 3, "repeated bridge key": 1, "winner lacks a site": 2}
    empty = revisions.rekey_problems(spark.createDataFrame([], columns), spark.createDataFrame([], "canonical_event_id string, source_updated_at timestamp, payload_hash string, site_key string"), canonical)
    assert empty.collect() == []


def test_verdict_of_clean_and_repeated_keys(spark):
    health = spark.createDataFrame([("RECONCILED", 2), ("RECONCILED", None)], "health_status string, rejected_rows bigint")
    rejects, none = spark.range(2), spark.range(0)
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, v string")
    assert checks.verdict(health, none, {"rows": (rows, ["k", "v"])}, rejects).first().asDict() == {"batch_anomalies": 0, "health_rejects": 2, "window_anomalies": 0, "view_rejects": 2, "duplicate_rows": 0, "verdict": "pass"}
    assert checks.verdict(health, none, {"rows": (rows, ["k"])}, rejects).first().verdict == "review"
    assert checks.verdict(health.limit(0), none, {}, none).first().verdict == "review"  # no attempt is no success


def test_coverage_of_null_windows_and_unasked_attempts(spark):
    day = lambda k: T0 + timedelta(days=k)
    audit = spark.createDataFrame(
        [("a", "w1", "reconciled", day(0), day(1), 2, 2, 2), ("a", None, "reconciled", day(1), day(2), 0, 0, 0), ("b", "w1", "reconciled", day(0), day(1), 1, 1, 1)],
        "attempt_id string, window_id string, window_status string, window_starttime timestamp, window_endtime timestamp, count_before bigint, returned_rows bigint, count_after bigint",
    )
    requests = spark.createDataFrame([("a", day(0), day(2)), ("c", day(0), day(1))], "attempt_id string, low timestamp, cutoff timestamp")
    counts = spark.createDataFrame([("a", "w1", 2), ("a", None, 5), ("b", "w1", 1)], "attempt_id string, window_id string, window_rows bigint")
    got = {r.attempt_id: r for r in sweeps.coverage(audit, requests, counts).collect()}
    assert set(got) == {"a", "c"} and got["c"].sweep_state == "unsettled windows"
    assert (got["a"].leaves, got["a"].breaks, got["a"].differing_rows, got["a"].stray_windows, got["a"].sweep_state) == (2, 0, 0, 1, "counts disagree")  # a window without an id is none that can be told apart


def test_coverage_is_dealt_to_more_tasks_as_windows_grow(spark, monkeypatch):
    """No task sorts more than its share, whatever the number of shuffle partitions; results stay."""
    want = sorted(map(tuple, registry.QUERIES["sweep_coverage"](spark, SF).collect()))
    monkeypatch.setattr(sweeps, "TASK_WINDOWS", 250)
    found = registry.QUERIES["sweep_coverage"](spark, SF)
    windows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert found.rdd.getNumPartitions() >= windows / 250 > 20 and sorted(map(tuple, found.collect())) == want


# ---- many sites [K8, C9]


def places(n, seed):
    rng = np.random.default_rng(seed)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    lat[:40], lat[40:80] = 90 - 3 * rng.random(40), -90 + 3 * rng.random(40)
    lon[80:120], lon[120:160] = 180 - 2 * rng.random(40), -180 + 2 * rng.random(40)
    lat[160:164], lon[164:168] = [90, -90, 0, 0], [180, -180, 0, 179.9999999]
    return list(zip(range(n), lat.tolist(), lon.tolist(), strict=True))


def test_grid_equals_all_pairs(spark):
    points = spark.createDataFrame([*places(400, 0), (9999, None, None), (0, 1.0, 2.0)], "p int, latitude double, longitude double").cache()
    sites = spark.createDataFrame([*places(300, 1), (9998, 5.0, None)], "s int, site_latitude double, site_longitude double").cache()
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("site_latitude"), F.col("site_longitude"))
    pairs = points.where("latitude IS NOT NULL").crossJoin(sites.where("site_longitude IS NOT NULL")).select("p", "s", km.alias("km")).toPandas()
    for radius in (1, 250, 3000, 12_000, 20_015):
        found = grid.within(points, sites, radius)
        near = pairs[pairs.km <= radius]
        assert sorted((r.p, r.s) for r in found.collect()) == sorted(zip(near.p.tolist(), near.s.tolist(), strict=True))
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()
    assert grid.with_cells(sites, 250).count() < 13 * 300
    with pytest.raises(ValueError, match="radius"):
        grid.within(points, sites, 0)


def test_sites_are_dealt_to_few_cells(spark):
    """What is shuffled of the sites is about five rows each."""
    sites = spark.createDataFrame(places(3000, 2), "s int, site_latitude double, site_longitude double")
    assert grid.with_cells(sites, 150).count() < 6 * 3000


def test_a_crowded_cell_is_no_single_task(spark, monkeypatch):
    """Points about a pole meet most of the sites; their cells are dealt to several tasks, and all pairs are found."""
    monkeypatch.setattr(grid, "POINTS", 50, raising=False)
    rng = np.random.default_rng(5)
    spread = lambda n, by: [(k, 89.9 - by * float(rng.random()) if k % 2 else float(rng.uniform(-90, 90)), 10 * float(rng.random())) for k in range(n)]
    points = spark.createDataFrame(spread(1500, 0.5), "p int, latitude double, longitude double").coalesce(1).cache()
    sites = spark.createDataFrame(spread(1200, 0.5), "s int, site_latitude double, site_longitude double").coalesce(1).cache()
    found = grid.within(points, sites, 150)
    assert found.columns == ["p", "latitude", "longitude", "s", "site_latitude", "site_longitude", "epicentral_distance_km"]
    tasks = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("site_latitude"), F.col("site_longitude"))
    want = points.crossJoin(sites).where(km <= 150).select("p", "s")
    assert sum(tasks) == want.count() > 400_000 and found.select("p", "s").exceptAll(want).isEmpty()
    assert max(tasks) < 0.8 * sum(tasks)


# ---- many ranges and nested windows [C3, I7]


@pytest.fixture(scope="module")
def ranges():
    rng = random.Random(3)
    lengths = [0, 1e-6, 1, 2, 60, 3600, 86_400, 9 * 86_400, 3.5]
    starts = [T0 + timedelta(seconds=rng.randrange(-100, 86_400 * 30)) for _ in range(300)]
    return [(k, rng.randrange(5), s, s + timedelta(seconds=rng.choice(lengths))) for k, s in enumerate(starts)] + [(900, 1, None, T0), (901, 1, T0, T0 - timedelta(1))]


def test_ranges_by_bins_equal_all_pairs(spark, ranges):
    rng = random.Random(4)
    rows = [(k, rng.randrange(5), T0 + timedelta(seconds=rng.randrange(86_400 * 30))) for k in range(300)] + [(700, 1, None)] + [(800 + k, r[1], r[2]) for k, r in enumerate(ranges[:100])]
    a = spark.createDataFrame(rows, "i int, k int, at timestamp")
    b = spark.createDataFrame(ranges, "j int, k int, s timestamp, e timestamp")
    found = intervals.in_ranges(a, "at", b, "s", "e", ["k"])
    want = sorted((i, j) for i, k, at in rows for j, q, s, e in ranges if at and s and k == q and s <= at < e)
    assert sorted((r.i, r.j) for r in found.collect()) == want and len(want) > 300
    assert sorted((r.i, r.j) for r in intervals.in_ranges(a.drop("k"), "at", b.drop("k"), "s", "e").collect()) == sorted((i, j) for i, _, at in rows for j, _, s, e in ranges if at and s and s <= at < e)
    assert intervals.in_ranges(a, "at", b.limit(0), "s", "e", ["k"]).count() == 0


def test_few_long_ranges_are_dealt_to_many_bins(spark):
    """Rare lengths take narrower bins, so that no bin holds all ranges and rows of a long time; the rows dealt stay in proportion."""
    short = [(k, T0 + timedelta(minutes=7 * k), T0 + timedelta(minutes=7 * k + 60)) for k in range(2000)]
    long = [(5000 + k, T0 + timedelta(hours=k), T0 + timedelta(hours=k + 200)) for k in range(20)]
    b = spark.createDataFrame(short + long, "j int, s timestamp, e timestamp")
    held, widths = intervals.dealt(b, "s", "e")
    bins = {r.j: r.n for r in held.groupBy("j").agg(F.count("*").alias("n")).collect()}
    assert all(bins[k] <= 4 for k, *_ in short) and all(32 <= bins[k] <= intervals.SPREAD + 1 for k, *_ in long)
    assert {r.level for r in held.select("level").distinct().collect()} == set(widths)
    rows = [(k, T0 + timedelta(minutes=11 * k)) for k in range(1500)]
    found = intervals.in_ranges(spark.createDataFrame(rows, "i int, at timestamp"), "at", b, "s", "e")
    assert sorted((r.i, r.j) for r in found.collect()) == sorted((i, j) for i, at in rows for j, s, e in short + long if s <= at < e)


def test_equal_ranges_come_pack_by_pack(spark, tmp_path, monkeypatch):
    """Rows of equal ranges repeat in the order that a store by columns writes short, and one crowded bin is dealt to several tasks."""
    monkeypatch.setattr(intervals, "LOOKS", 100, raising=False)
    starts = [T0 + timedelta(hours=9 * (j % 12)) for j in range(4800)]
    b = spark.createDataFrame([(j * 7, j % 2, s, s + timedelta(hours=j // 12 % 3)) for j, s in enumerate(starts)], "j long, k int, s timestamp, e timestamp")
    a = spark.createDataFrame([(i * 13, i % 2, T0 + timedelta(minutes=i % 40 + 60 * 27 * (i % 3 == 0))) for i in range(4000)], "i long, k int, at timestamp")
    found = intervals.in_ranges(a, "at", b, "s", "e", ["k"])
    assert found.columns == ["k", "i", "at", "j", "s", "e"]
    want = a.join(b, "k").where("at >= s AND at < e").select("i", "j")
    found.select("i", "j", F.spark_partition_id().alias("task")).write.parquet(f"{tmp_path}/found")
    stored = spark.read.parquet(f"{tmp_path}/found")
    assert stored.count() == want.count() > 500_000 and stored.select("i", "j").exceptAll(want).isEmpty()
    assert stored.select("task").distinct().count() > 1
    assert sum(f.stat().st_size for f in (tmp_path / "found").glob("*.parquet")) < 0.5 * stored.count()
    held = intervals.packed(b, "s", "e", ["k"])
    assert held.count() < 100 and held.select(F.sum(F.size("pack"))).first()[0] == b.where("s < e").count() and held.select(F.max(F.size("pack"))).first()[0] <= intervals.PACK
    bare = intervals.in_ranges(a, "at", b.drop("j", "k"), "s", "e")
    assert bare.columns == ["i", "k", "at", "s", "e"] and bare.count() == a.drop("k").join(b.drop("j", "k")).where("at >= s AND at < e").count()


def brute_cover(held):
    upto, stretches, nested, overlapping = None, 0, 0, 0
    for s, e in sorted((s, max(s, e)) for s, e in held):
        stretches += upto is None or s > upto
        nested += upto is not None and e <= upto
        overlapping += upto is not None and s < upto
        upto = e if upto is None else max(upto, e)
    return len(held), stretches, stretches - 1, nested, overlapping, min(s for s, _ in held), upto


@pytest.mark.parametrize("split", [True, False])
def test_union_cover_equals_a_sweep(spark, ranges, split):
    frame = spark.createDataFrame(ranges, "j int, k int, s timestamp, e timestamp")
    got = {r.k: tuple(r)[1:] for r in intervals.union_cover(frame, "k", "s", "e", split).collect()}
    assert got == {k: brute_cover([(s, e) for _, q, s, e in ranges if q == k and s]) for k in range(5)}
    nested = spark.createDataFrame([(1, 0, 10), (1, 2, 3), (1, 10, 12)], "k int, s int, e int")
    assert intervals.union_cover(nested, "k", "s", "e", split).first().gaps == 0


def test_months_of_rows_clip_short_months(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-03-31 10:20:00' AS at, 2 AS n UNION ALL SELECT NULL, 2 UNION ALL SELECT timestamp_ntz'2024-03-31', 0")
    got = [(r.window_no, r.window_start, r.window_end) for r in windows.months_before_each(frame, "at", F.col("n")).orderBy("window_no").collect()]
    assert got == [(1, datetime(2024, 1, 31, 10, 20), datetime(2024, 2, 29, 10, 20)), (2, datetime(2024, 2, 29, 10, 20), datetime(2024, 3, 31, 10, 20))]


@pytest.mark.parametrize("text", ["2024-1", "2024-13", "24-01", "2024-01 ", "0000-01", "٢٠٢٤-01"])
def test_a_daily_month_is_written_in_full(text):
    with pytest.raises(ValueError, match="YYYY-MM"):
        windows.sweep_windows(datetime(2000, 1, 1, tzinfo=UTC), datetime(2024, 6, 1, tzinfo=UTC), 10, monthly_year=2020, daily_month=text)


# ---- counts that merge [D5, K22]


def test_bitmaps_count_once_and_merge(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(200_000), rng.randrange(3), rng.randrange(4)) for _ in range(4000)] + [(n, 0, 0) for n in (0, 0, 32_766, 32_767, 32_768, 65_535, 65_536, 1 << 40)] + [(None, 1, 1)]
    frame = spark.createDataFrame(rows, "n bigint, a int, b int")
    small = distinct.sketch(frame, F.col("n"), "a", "b")
    count = lambda *keys: sorted(map(tuple, frame.groupBy(*keys).agg(F.count_distinct("n")).collect()))
    assert sorted(map(tuple, distinct.count(small, ["a", "b"], "c").collect())) == count("a", "b")
    assert sorted(map(tuple, distinct.count(distinct.roll_up(small, "a"), ["a"], "c").collect())) == count("a")
    assert sorted(map(tuple, distinct.count(distinct.roll_up(small), [], "c").collect())) == count()
    with pytest.raises(Exception, match="negative"):
        distinct.sketch(spark.sql("SELECT -1L AS n"), F.col("n")).collect()


# ---- row numbers [A10, H11]


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    rng = random.Random(6)
    files = {name: [rng.choice(["", "x" * rng.randrange(200), "é " * 30]) for _ in range(rng.randrange(900, 1500))] for name in ("a", "b", "c")}
    files["d"], files["e"] = ["one"], ["", "", "three"]
    for name, lines in files.items():
        (tmp_path / f"{name}.txt").write_bytes("\n".join(lines).encode() + (b"\n" if name == "a" else b""))
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    found = landing.numbered_lines(own, f"file://{tmp_path}/*.txt")
    assert own.read.text(f"file://{tmp_path}/*.txt").rdd.getNumPartitions() > 20
    got = sorted((r.file[-5], r.number, r.line) for r in found.collect())
    want = sorted((name, k, line) for name, lines in files.items() for k, line in enumerate(lines, 1))
    assert [g for g in got if g[2]] == [w for w in want if w[2]]  # a blank last line may be none


# ---- state [E1, I9, I10]


def test_replays_and_late_revisions_end_in_the_current_state(spark, tmp_path):
    schema = "canonical_event_id string, source_updated_at timestamp, payload_hash string, fetched_at timestamp, stage_file_name string, stage_file_row_number bigint, source_status string, magnitude double"
    day = lambda k: T0 + timedelta(days=k)
    row = lambda i, updated, fetched, status, h="h": (i, day(updated), h, day(fetched), "f", 1, status, float(updated))
    batches = [
        [row("a", 1, 1, "automatic"), row("b", 1, 1, "automatic"), row("a", 2, 2, "reviewed")],
        [row("a", 3, 3, "deleted"), row("b", 0, 9, "automatic"), row("c", 5, 5, "deleted")],
        [row("a", 1, 1, "automatic"), row("a", 2, 2, "reviewed"), row("c", 4, 8, "automatic"), row("b", 1, 1, "reviewed", "z")],
        [row("c", 6, 6, "automatic")],
    ]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    log, state, folder = (f"file://{tmp_path}/{name}" for name in ("log", "state", "files"))
    for k, frame in enumerate(frames):  # files come between runs, which take up the state where it was
        frame.coalesce(1).write.parquet(f"{folder}/part={k}")
        current.maintain(spark, f"{folder}/*", frame.schema, log, state).awaitTermination()
    every = frames[0].union(frames[1]).union(frames[2]).union(frames[3])
    want = revisions.current(every)
    got = current.current(spark, log, frames[0].schema)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect()) and {r.canonical_event_id for r in got.collect()} == {"b", "c"}
    assert spark.read.parquet(log).where("batch = 2").count() == 1  # of the replays, only b's other payload wins
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")


# ---- the anchor's end [J6]


def test_an_anchor_ends_with_the_id(spark):
    case = dict(case_id="c", site_key="seattle", radius_km=250.0, event_count=1, nearest_event_id="u12", nearest_distance_km=1.0, nearest_magnitude=2.0, nearest_source_status="reviewed", nearest_record_age_hours=3.0)
    for text, found in (("away from u12.", True), ("away from   U12, x.", True), ("away from u123.", False), ("away from u1.", False), ("runaway from u12.", False)):
        frame = spark.createDataFrame([case | {"message": text}])
        assert ("distance anchored to event ID" in frame.select(briefs.problems(F.col("message")).alias("p")).first().p) == found


def test_health_of_parts_in_any_order(spark, tmp_path):
    """Facts before receipts, counts in two batches, a process that comes late and a receipt told anew; no task of the state runs Python."""
    none = dict.fromkeys(c for part in health.PARTS.values() for c in part)
    batches = [
        {"fact": [("a", {"f_attempt_id": "a", "f_processed_rows": 2})], "count": [("a", {"raw_rows": 1, "staging_rows": None, "staging_reject_rows": 1}), ("b", {"raw_rows": 9})], "process": [("a", {"finished": 9, "process_attempt_id": "p9"})]},
        {"receipt": [("a", {"load_status": "complete"}), ("c", {"load_status": "failed"})], "count": [("a", {"raw_rows": 2, "staging_rows": 3, "staging_reject_rows": 0})], "process": [("a", {"finished": 3, "process_attempt_id": "p3"})]},
        {"receipt": [("a", {"load_status": "told anew"})]},
    ]
    log, state = f"file://{tmp_path}/log", f"file://{tmp_path}/state"
    folders = {name: f"file://{tmp_path}/{name}" for name in health.PARTS}
    schema = {name: "attempt_id string, " + ", ".join(f"{c} {kind}" for c, kind in columns.items()) for name, columns in health.PARTS.items()}
    for batch in batches:
        for name, columns in health.PARTS.items():
            rows = [(i, *((none | told)[c] for c in columns)) for i, told in batch.get(name, [])]
            spark.createDataFrame(rows, schema[name]).coalesce(1).write.mode("append").parquet(folders[name])
        query = health.maintain(spark, folders, log, state)
        query.awaitTermination()
    got = {r.attempt_id: r for r in health.health(spark, log).collect()}
    assert set(got) == {"a", "c"} and (got["c"].raw_rows, got["c"].finished, got["c"].f_processed_rows) == (0, None, None)
    a = got["a"]
    assert (a.load_status, a.raw_rows, a.staging_rows, a.staging_reject_rows, a.process_attempt_id, a.f_processed_rows) == ("told anew", 3, 3, 1, "p9", 2)
    every = health.joined({name: spark.read.schema(schema[name]).parquet(folder) for name, folder in folders.items()})
    assert not any(name in every._jdf.queryExecution().toString() for name in ("Python", "Pandas", "TransformWithState"))


def test_current_state_runs_no_python(spark):
    rows = spark.createDataFrame([("a", T0, "h", T0, "f", 1, "automatic"), ("a", None, "z", T0, "f", 2, "late")], "canonical_event_id string, source_updated_at timestamp, payload_hash string, fetched_at timestamp, stage_file_name string, stage_file_row_number bigint, source_status string")
    plan = current.changes(rows)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "TransformWithState"))
