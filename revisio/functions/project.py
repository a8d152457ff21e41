"""Typed projection of a source feature with one reject reason [K1, H13-H16].

One VARIANT goes in. Checks are ordered; the first that fails names the reason, and a field
is filled only if no check before its own has failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.schema import STAGING_PARSER_VERSION

#: Epoch milliseconds of the years 1 to 9999.
EPOCH_RANGE = (-62_135_596_800_000, 253_402_300_799_999)


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _type(v: Column) -> Column:
    """SQL type name of a variant; VOID for JSON null and for what is missing."""
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _is_string(v: Column) -> Column:
    return _type(v) == "STRING"


def _blank(text: Column) -> Column:
    return ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def _number(v: Column) -> Column:
    """Finite double, or NULL for what is not a JSON number."""
    value = F.try_variant_get(v, "$", "double")
    kind = _type(v)
    return F.when(((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")) & (F.abs(value) < float("inf")), value)


def _epoch(v: Column) -> Column:
    ms = F.when(_type(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))
    return F.when(ms.between(*EPOCH_RANGE), F.timestamp_millis(ms))


def project(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds the twelve typed fields, staging_parser_version and reject_reason."""
    p = F.col(payload)
    names = {"id": "$.id", "properties": "$.properties", "geometry": "$.geometry", "time": "$.properties.time", "updated": "$.properties.updated", "status": "$.properties.status", "ids": "$.properties.ids", "mag": "$.properties.mag", "mag_type": "$.properties.magType", "place": "$.properties.place", "geo_type": "$.geometry.type", "at": "$.geometry.coordinates"}
    staged = rows.withColumns({f"_{k}": _get(p, path) for k, path in names.items()})
    c = {k: F.col(f"_{k}") for k in names}
    void = lambda v: _type(v) == "VOID"
    point_list = _type(c["at"]).startswith("ARRAY")
    size = F.when(point_list, F.size(F.try_variant_get(c["at"], "$", "array<variant>")))
    staged = staged.withColumns({
        "_status_text": F.when(_is_string(c["status"]), _get(c["status"], "$", "string")),
        "_id_text": F.when(_is_string(c["id"]), _get(c["id"], "$", "string")),
        "_ids_text": F.when(_is_string(c["ids"]), F.filter(F.split(_get(c["ids"], "$", "string"), ","), lambda x: x != "")),
        "_ids_list": F.when(_type(c["ids"]).startswith("ARRAY"), _get(c["ids"], "$", "array<variant>")),
        "_lon": _number(_get(c["at"], "$[0]")), "_lat": _number(_get(c["at"], "$[1]")), "_depth": _number(_get(c["at"], "$[2]")), "_depth_given": ~void(_get(c["at"], "$[2]")),
        "_size": size, "_origin": _epoch(c["time"]), "_updated_at": _epoch(c["updated"]), "_magnitude": _number(c["mag"]),
    })
    gone, at_zero = F.coalesce(F.col("_status_text") == "deleted", F.lit(False)), (F.col("_lon") == 0) & (F.col("_lat") == 0)
    bad_list = F.exists("_ids_list", lambda e: _type(e) != "STRING")
    text_or_void = lambda v: void(v) | _is_string(v)
    no_place = void(c["geometry"]) & gone
    checks = [
        ("invalid_feature", ~_type(p).startswith("OBJECT")),
        ("invalid_source_event_id", _blank(F.col("_id_text"))),
        ("invalid_properties", ~_type(c["properties"]).startswith("OBJECT")),
        ("source_stub_record", void(c["time"]) & void(c["mag"]) & void(c["status"])),
        ("invalid_origin_time", F.col("_origin").isNull()),
        ("invalid_source_updated_at", F.col("_updated_at").isNull()),
        ("invalid_source_status", _blank(F.col("_status_text"))),
        ("invalid_associated_ids", ~void(c["ids"]) & F.col("_ids_text").isNull() & F.coalesce(bad_list, F.lit(True))),
        ("invalid_magnitude", ~void(c["mag"]) & F.col("_magnitude").isNull()),
        ("invalid_magnitude_type", ~text_or_void(c["mag_type"])),
        ("invalid_place", ~text_or_void(c["place"])),
        (None, no_place),
        ("invalid_geometry", ~_type(c["geometry"]).startswith("OBJECT") | ~F.coalesce(F.when(_is_string(c["geo_type"]), _get(c["geo_type"], "$", "string")) == "Point", F.lit(False)) | ~F.coalesce(F.col("_size").isin(2, 3), F.lit(False))),
        ("invalid_longitude", ~F.coalesce(F.col("_lon").between(-180, 180), F.lit(False))),
        ("invalid_latitude", ~F.coalesce(F.col("_lat").between(-90, 90), F.lit(False))),
        (None, at_zero & gone),
        ("placeholder_location", at_zero),
        ("invalid_depth_km", F.col("_depth_given") & F.col("_depth").isNull()),
    ]
    stop = F.lit(len(checks))
    for k, (_, failed) in reversed(list(enumerate(checks))):
        stop = F.when(F.coalesce(failed, F.lit(False)), F.lit(k)).otherwise(stop)
    staged = staged.withColumn("_stop", stop)
    after = {name: k for k, (name, _) in enumerate(checks) if name}
    when = lambda check, value: F.when(F.col("_stop") > after[check], value)
    ids = F.coalesce(F.col("_ids_text"), F.transform("_ids_list", lambda e: F.try_variant_get(e, "$", "string")))
    located = F.col("_stop") > after["placeholder_location"]
    fields = {
        "staging_parser_version": F.lit(STAGING_PARSER_VERSION),
        "source_event_id": when("invalid_source_event_id", F.col("_id_text")),
        "origin_time": when("invalid_origin_time", F.col("_origin")),
        "source_updated_at": when("invalid_source_updated_at", F.col("_updated_at")),
        "source_status": when("invalid_source_status", F.col("_status_text")),
        "associated_ids": when("invalid_associated_ids", ids),
        "magnitude": when("invalid_magnitude", F.col("_magnitude")),
        "magnitude_type": when("invalid_magnitude_type", _get(c["mag_type"], "$", "string")),
        "place": when("invalid_place", _get(c["place"], "$", "string")),
        "longitude": F.when(located, F.col("_lon")), "latitude": F.when(located, F.col("_lat")),
        "depth_km": when("invalid_depth_km", F.col("_depth")),
        "reject_reason": F.element_at(F.array(*(F.lit(n).cast("string") for n, _ in checks), F.lit(None).cast("string")), F.col("_stop") + 1),
    }
    return staged.withColumns(fields).drop(*(x for x in staged.columns if x.startswith("_")))
