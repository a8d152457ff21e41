"""One case per reject reason, and what stays filled before the failing check."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from revisio.functions.project import project

GOOD = {"id": "e1", "properties": {"time": 1_700_000_000_000, "updated": 1_700_000_060_000, "status": "reviewed", "mag": 1.5, "magType": "ml", "place": "here", "ids": ",e1,e2,"}, "geometry": {"type": "Point", "coordinates": [-122.0, 47.0, 3.5]}}


def changed(path, value):
    f = copy.deepcopy(GOOD)
    at = f
    for p in path[:-1]:
        at = at[p]
    at[path[-1]] = value
    return f


P, G = ("properties",), ("geometry",)
CASES = [
    (GOOD, None), ([1], "invalid_feature"), (changed(("id",), " \t"), "invalid_source_event_id"), (changed(("id",), 5), "invalid_source_event_id"), (changed(P, "x"), "invalid_properties"),
    (changed(P, {"time": None, "ids": "a"}), "source_stub_record"), (changed((*P, "time"), True), "invalid_origin_time"), (changed((*P, "time"), "5"), "invalid_origin_time"), (changed((*P, "time"), 1.0), "invalid_origin_time"), (changed((*P, "time"), 10**15), "invalid_origin_time"),
    (changed((*P, "updated"), None), "invalid_source_updated_at"), (changed((*P, "status"), ""), "invalid_source_status"), (changed((*P, "ids"), ["x", None]), "invalid_associated_ids"), (changed((*P, "ids"), 7), "invalid_associated_ids"), (changed((*P, "ids"), []), None), (changed((*P, "ids"), None), None),
    (changed((*P, "mag"), "1"), "invalid_magnitude"), (changed((*P, "mag"), None), None), (changed((*P, "magType"), 3), "invalid_magnitude_type"), (changed((*P, "place"), {}), "invalid_place"),
    (changed(G, None), "invalid_geometry"), (changed((*G, "type"), "Line"), "invalid_geometry"), (changed((*G, "coordinates"), [1]), "invalid_geometry"), (changed((*G, "coordinates"), [181, 1]), "invalid_longitude"), (changed((*G, "coordinates"), [1, -91]), "invalid_latitude"), (changed((*G, "coordinates"), ["1", 1]), "invalid_longitude"),
    (changed((*G, "coordinates"), [0, 0]), "placeholder_location"), (changed((*G, "coordinates"), [1, 2, "x"]), "invalid_depth_km"), (changed((*G, "coordinates"), [1, 2, None]), None),
]


@pytest.fixture(scope="module")
def projected(spark):
    rows = [(k, json.dumps(f)) for k, (f, _) in enumerate(CASES)]
    gone = copy.deepcopy(GOOD)
    gone["properties"]["status"] = "deleted"
    gone["geometry"] = None
    zero = changed((*G, "coordinates"), [0, 0])
    zero["properties"]["status"] = "deleted"
    rows += [(100, json.dumps(gone)), (101, json.dumps(zero))]
    out = project(spark.createDataFrame(rows, "k int, j string").select("k", F.parse_json("j").alias("payload"))).drop("payload").collect()
    return {r.k: r for r in out}


def test_reasons(projected):
    assert [projected[k].reject_reason for k in range(len(CASES))] == [reason for _, reason in CASES]


def test_fields(projected):
    good = projected[0]
    assert (good.source_event_id, good.associated_ids, good.magnitude, good.depth_km, good.longitude) == ("e1", ["e1", "e2"], 1.5, 3.5, -122.0)
    assert good.origin_time.isoformat() == "2023-11-14T22:13:20"
    depth = next(projected[k] for k, c in enumerate(CASES) if c[1] == "invalid_depth_km")
    assert (depth.longitude, depth.latitude, depth.depth_km) == (1.0, 2.0, None)
    status = next(projected[k] for k, c in enumerate(CASES) if c[1] == "invalid_source_status")
    assert status.origin_time is not None and status.source_status is None and status.magnitude is None


def test_tombstones_without_place(projected):
    for k in (100, 101):
        assert projected[k].reject_reason is None and projected[k].longitude is None and projected[k].source_status == "deleted"
