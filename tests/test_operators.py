"""Domain operators against hand-made cases and invariants of the adapter."""

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from revisio.functions import geo
from revisio.operators import aliases, components, merge, revisions, windows
from revisio.sources import adapter

SF = "/root/testdata/sf0.01"


def test_distance_and_null_guard(spark):
    km = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(179.0), F.lit(0.0), F.lit(-179.0)).alias("km"), geo.haversine_km(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0)).alias("none")).first()
    assert round(km.km, 3) == 222.390 and km.none is None
    with pytest.raises(Exception, match="half null"):
        spark.range(1).select(geo.haversine_km(F.lit(1.0), F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0))).collect()


def test_adapter_invariants(spark):
    facts = revisions.dedup(adapter.accepted(spark, SF)).cache()
    assert facts.count() == 9_512
    assert revisions.current(facts).count() == 2_303
    b = geo.bridge(facts).agg(F.count("*"), F.count_if(F.col("epicentral_distance_km").isNull()), F.count_if("within_radius")).first()
    assert tuple(b) == (28_536, 2_799, 2_290 + 1_394 + 1_637)
    early = revisions.current(facts.where("source_status <> 'deleted'")).join(revisions.current(facts), "canonical_event_id", "left_anti").count()
    assert early == 462
    facts.unpersist()


def test_dedup_does_not_depend_on_order(spark):
    rows = adapter.accepted(spark, "/root/testdata/sf0.001")
    one = revisions.dedup(rows.repartition(7, F.rand(1))).select("payload_hash", "fetched_at").exceptAll(revisions.dedup(rows.coalesce(1)).select("payload_hash", "fetched_at"))
    assert one.count() == 0


def _find(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randint(0, 300):03}", f"n{r.randint(0, 300):03}") for _ in range(220)] + [(f"c{k:03}", f"c{k + 1:03}") for k in range(60)] + [("hub", f"h{k}") for k in range(80)] + [("solo", "solo")]
    got = {x.source_event_id: x.canonical_id for x in aliases.components_of(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == _find(edges)
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_aliases(spark):
    rows = [("b", ["b", "a"]), ("c", None), ("d", ["c"]), ("e", [])]
    got = {x.source_event_id: x.canonical_id for x in aliases.canonical_ids(spark.createDataFrame(rows, "source_event_id string, associated_ids array<string>")).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "e"}
    with pytest.raises(Exception, match="blank source id"):
        aliases.canonical_ids(spark.createDataFrame([("b", [" "])], "source_event_id string, associated_ids array<string>")).collect()


def test_rekey_keeps_the_later_fetch(spark):
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    facts = spark.createDataFrame([("z", at(0), "h", "z", at(9), "f", 1), ("a", at(0), "h", "a", at(5), "f", 2)], "canonical_event_id string, source_updated_at timestamp, payload_hash string, source_event_id string, fetched_at timestamp, stage_file_name string, stage_file_row_number bigint")
    bridges = spark.createDataFrame([(k, at(0), "h", s, d) for k, d in (("z", 1.0), ("a", 2.0)) for s in "xyz"], "canonical_event_id string, source_updated_at timestamp, payload_hash string, site_key string, km double")
    kept, moved = revisions.rekey(facts, bridges, spark.createDataFrame([("z", "a"), ("a", "a")], "source_event_id string, canonical_id string"))
    assert [(r.canonical_event_id, r.source_event_id) for r in kept.collect()] == [("a", "z")]
    assert sorted((r.canonical_event_id, r.site_key, r.km) for r in moved.collect()) == [("a", s, 1.0) for s in "xyz"]
    with pytest.raises(Exception, match="no canonical id for"):
        revisions.rekey(facts, bridges, spark.createDataFrame([("z", "a")], "source_event_id string, canonical_id string"))[0].collect()


def test_merges(spark):
    t = spark.createDataFrame([(1, 10, "t"), (2, 10, "t")], "k int, v int, w string")
    s = spark.createDataFrame([(2, 11, "s"), (3, 12, "s")], "k int, v int, w string")
    assert sorted(map(tuple, merge.insert_only(t, s, ["k"]).collect())) == [(3, 12, "s")]
    assert sorted(map(tuple, merge.upsert(t, s, ["k"], ["v"]).collect())) == [(1, 10, "t", "kept"), (2, 11, "t", "updated"), (3, 12, "s", "inserted")]
    assert sorted(map(tuple, merge.upsert(t, s, ["k"], ["v"], F.col("s.v") > 20).collect()))[1] == (2, 10, "t", "kept")
    assert sorted(map(tuple, merge.update_from(t, s, ["k"], {"w": "w"}).collect())) == [(1, 10, "t"), (2, 10, "s")]
    assert sorted(map(tuple, merge.delete(t, s, ["k"]).collect())) == [(1, 10, "t")]


def test_history_windows(spark):
    rows = windows.history_windows(spark, datetime(2026, 9, 29, tzinfo=UTC)).orderBy("window_no").collect()
    assert len(rows) == 180 and rows[0].window_start == datetime(2021, 9, 29) and rows[0].window_end == datetime(2021, 10, 29)
    assert all(a.window_end == b.window_start for a, b in zip(rows[:60], rows[1:60], strict=False))
    leap = windows.history_windows(spark, datetime(2024, 2, 29, 5, 6, 7, tzinfo=UTC)).orderBy("window_no").first()
    assert leap.window_start == datetime(2019, 2, 28, 5, 6, 7)


def test_sweep_windows():
    start, end = datetime(1, 1, 1, tzinfo=UTC), datetime(2026, 9, 30, tzinfo=UTC)
    got = windows.sweep_windows(start, end, 50)
    assert len(got) == 46 and got[0][0] == start and got[-1][1] == end and all(a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    daily = windows.sweep_windows(datetime(2000, 1, 1), datetime(2024, 6, 1), 10, monthly_year=2020, daily_month="2024-02")
    assert sum((b - a).days == 1 for a, b in daily) == 29
    with pytest.raises(ValueError):
        windows.sweep_windows(start, end, 0)
    with pytest.raises(ValueError):
        windows.midpoint_split(start, start)
