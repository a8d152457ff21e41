"""Queries of the contracts: projection, sweeps, re-keying, inventory, verdicts, briefs, and their SQL twins."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from revisio.functions import geo, project
from revisio.operators import briefs, merge, revisions, sweeps, views, windows
from revisio.plans import checks, inventory, migrate
from revisio.plans.registry import _MONTHS, CUTOFF, KEY, QUERIES, _bridge, _current, _facts, _health, _lines, _obs, _table, query
from revisio.plans.lineage import Scratch
from revisio.schema import REVISION_KEY, SITES
from revisio.sources import adapter, landing

# ---- predicates and variants [B5, B9, B12, B15, H9]


@query("SELECT attempt_id, fetched_at FROM att WHERE fetched_at BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-12-31'", "att")
def closed_range(spark, d):
    """Both ends of the requested range count [B5]."""
    low, high = F.lit("1995-01-01").cast("timestamp"), F.lit("1995-12-31").cast("timestamp")
    return adapter.attempts(spark, d).where(F.col("fetched_at").between(low, high)).select("attempt_id", "fetched_at")


@query("SELECT event_id, origin_time FROM obs WHERE fetched_at >= TIMESTAMP '2024-01-10' AND fetched_at < TIMESTAMP '2024-01-12' AND event_type = 'click'", "obs")
def bound_parameters(spark, d):
    """Values as parameters, never as text [B15]."""
    sql = "SELECT event_id, origin_time FROM {obs} WHERE fetched_at >= :low AND fetched_at < :high AND event_type = :kind"
    return checks.bound(spark, sql, {"low": datetime(2024, 1, 10, tzinfo=UTC), "high": datetime(2024, 1, 12, tzinfo=UTC), "kind": "click"}, obs=_obs(spark, d))


_NULLS = """'{' || CASE event_id % 4 WHEN 0 THEN '"gaps":null' WHEN 1 THEN '"x":1' WHEN 2 THEN '"gaps":[]' ELSE '"gaps":[' || event_id || ',null,"g"]' END || '}'"""


@query(f"SELECT event_id, coalesce(json_type(j, '$.gaps') = 'NULL', FALSE) AS json_null, json_type(j, '$.gaps') IS NULL AS missing, coalesce(json_array_length(j, '$.gaps'), 0)::INTEGER AS gap_count FROM (SELECT event_id, ({_NULLS})::JSON AS j FROM events)")
def json_null_missing(spark, d):
    """JSON null, a missing field, an empty array and its size are four things [B9, H9]."""
    v = F.variant_get("v", "$.gaps", "variant")
    size = F.coalesce(F.size(F.try_variant_get("v", "$.gaps", "array<variant>")), F.lit(0))
    rows = _table(spark, d, "events").select("event_id", F.parse_json(F.expr(_NULLS)).alias("v"))
    return rows.select("event_id", F.coalesce(F.is_variant_null(v), F.lit(False)).alias("json_null"), v.isNull().alias("missing"), F.greatest(size, F.lit(0)).alias("gap_count"))


@query(f"SELECT event_id, (i - 1)::BIGINT AS position, coalesce(json_type(j, '$.gaps[' || (i - 1) || ']') = 'NULL', FALSE) AS item_null FROM (SELECT event_id, j, unnest(range(1, json_array_length(j, '$.gaps')::BIGINT + 1)) AS i FROM (SELECT event_id, ({_NULLS})::JSON AS j FROM events) WHERE json_type(j, '$.gaps') = 'ARRAY')")
def unnest_null_empty(spark, d):
    """Null, missing and empty arrays lose their row; null items stay [B12]."""
    rows = _table(spark, d, "events").select("event_id", F.variant_get(F.parse_json(F.expr(_NULLS)), "$.gaps", "variant").alias("v"))
    flat = rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    return flat.select("event_id", F.col("pos").cast("long").alias("position"), F.coalesce(F.is_variant_null("value"), F.lit(False)).alias("item_null"))


# ---- typed projection [K1]

#: A feature of each event as JSON text, the same expression in both dialects: one case of 25 for each check and way through.
_FEATURE = """CASE event_id % 25 WHEN 0 THEN '[1]' ELSE '{' ||
  CASE event_id % 25 WHEN 1 THEN '' WHEN 2 THEN '"id":"  ",' ELSE '"id":"u' || event_id || '",' END || '"properties":' ||
  CASE event_id % 25 WHEN 3 THEN '[]' ELSE '{"time":' || CASE event_id % 25 WHEN 4 THEN 'null' WHEN 5 THEN '"soon"' ELSE '' || (1700000000000 + event_id * 1000) END ||
  ',"updated":' || CASE event_id % 25 WHEN 6 THEN '253402300800000' ELSE '' || (1700000000000 + event_id * 1000 + event_id % 7 * 60000) END ||
  CASE event_id % 25 WHEN 4 THEN '' ELSE ',"status":' || CASE event_id % 25 WHEN 7 THEN '" "' WHEN 13 THEN '"deleted"' WHEN 18 THEN '"deleted"' ELSE '"reviewed"' END END ||
  ',"ids":' || CASE event_id % 25 WHEN 8 THEN '7' WHEN 9 THEN '["u1",null]' WHEN 22 THEN '["u1","u2"]' WHEN 23 THEN '[]' WHEN 24 THEN 'null' ELSE '",u' || event_id || ',u1,"' END ||
  ',"mag":' || CASE event_id % 25 WHEN 4 THEN 'null' WHEN 10 THEN '"big"' WHEN 23 THEN 'null' WHEN 21 THEN '2' ELSE '' || (event_id % 90) || '.25' END ||
  ',"magType":' || CASE event_id % 25 WHEN 11 THEN '3' WHEN 23 THEN 'null' ELSE '"ml"' END || ',"place":' || CASE event_id % 25 WHEN 12 THEN '["x"]' ELSE '"place ' || (event_id % 11) || '"' END || '}' END ||
  ',"geometry":' || CASE event_id % 25 WHEN 13 THEN 'null' WHEN 14 THEN 'null' ELSE '{"type":"' || CASE event_id % 25 WHEN 15 THEN 'Polygon' ELSE 'Point' END || '","coordinates":[' ||
  CASE event_id % 25 WHEN 16 THEN '180.5' WHEN 18 THEN '0' WHEN 19 THEN '0' ELSE '-' || (event_id % 179) || '.5' END || ',' ||
  CASE event_id % 25 WHEN 17 THEN '"north"' WHEN 18 THEN '0' WHEN 19 THEN '0' ELSE '' || (event_id % 89) || '.75' END || CASE event_id % 25 WHEN 20 THEN ',"deep"' WHEN 21 THEN '' ELSE ',' || (event_id % 50) END || ']}' END || '}' END"""


def _t(path: str) -> str:
    return f"coalesce(json_type(j, '{path}'), 'NULL')"


def _s(path: str) -> str:
    return f"json_extract_string(j, '{path}')"


def _is_n(path: str) -> str:
    return f"({_t(path)} IN ('UBIGINT', 'BIGINT', 'DOUBLE'))"


_P = "$.properties."
_XY = [f"try_cast({_s(f'$.geometry.coordinates[{k}]')} AS DOUBLE)" for k in range(3)]
_EPOCH = lambda f: f"NOT coalesce({_t(_P + f)} IN ('UBIGINT', 'BIGINT') AND try_cast({_s(_P + f)} AS BIGINT) BETWEEN -62135596800000 AND 253402300799999, FALSE)"
_GONE = f"coalesce({_t(_P + 'status')} = 'VARCHAR' AND {_s(_P + 'status')} = 'deleted', FALSE)"
_STOPS = [
    ("invalid_feature", f"{_t('$')} <> 'OBJECT'"), ("invalid_source_event_id", f"{_t('$.id')} <> 'VARCHAR' OR trim({_s('$.id')}) = ''"), ("invalid_properties", f"{_t('$.properties')} <> 'OBJECT'"),
    ("source_stub_record", " AND ".join(f"{_t(_P + f)} = 'NULL'" for f in ("time", "mag", "status"))), ("invalid_origin_time", _EPOCH("time")), ("invalid_source_updated_at", _EPOCH("updated")),
    ("invalid_source_status", f"{_t(_P + 'status')} <> 'VARCHAR' OR trim({_s(_P + 'status')}) = ''"),
    ("invalid_associated_ids", f"{_t(_P + 'ids')} NOT IN ('NULL', 'VARCHAR', 'ARRAY') OR ({_t(_P + 'ids')} = 'ARRAY' AND len(list_filter(json_type(j, '{_P}ids[*]'), lambda x: x <> 'VARCHAR')) > 0)"),
    ("invalid_magnitude", f"{_t(_P + 'mag')} <> 'NULL' AND NOT {_is_n(_P + 'mag')}"), ("invalid_magnitude_type", f"{_t(_P + 'magType')} NOT IN ('NULL', 'VARCHAR')"), ("invalid_place", f"{_t(_P + 'place')} NOT IN ('NULL', 'VARCHAR')"),
    ("", f"{_t('$.geometry')} = 'NULL' AND {_GONE}"),
    ("invalid_geometry", f"{_t('$.geometry')} <> 'OBJECT' OR coalesce({_s('$.geometry.type')}, '') <> 'Point' OR coalesce(json_array_length(j, '$.geometry.coordinates'), 0) NOT IN (2, 3)"),
    ("invalid_longitude", f"NOT coalesce({_is_n('$.geometry.coordinates[0]')} AND {_XY[0]} BETWEEN -180 AND 180, FALSE)"), ("invalid_latitude", f"NOT coalesce({_is_n('$.geometry.coordinates[1]')} AND {_XY[1]} BETWEEN -90 AND 90, FALSE)"),
    ("", f"{_XY[0]} = 0 AND {_XY[1]} = 0 AND {_GONE}"), ("placeholder_location", f"{_XY[0]} = 0 AND {_XY[1]} = 0"), ("invalid_depth_km", f"{_t('$.geometry.coordinates[2]')} <> 'NULL' AND NOT {_is_n('$.geometry.coordinates[2]')}"),
]
_AT = {name: k for k, (name, _) in enumerate(_STOPS) if name}
_IDS = f"CASE {_t(_P + 'ids')} WHEN 'VARCHAR' THEN array_to_string(list_filter(string_split({_s(_P + 'ids')}, ','), lambda x: x <> ''), ';') WHEN 'ARRAY' THEN array_to_string(json_extract_string(j, '{_P}ids[*]'), ';') END"


def _after(check: str, value: str) -> str:
    return f"CASE WHEN stop > {_AT[check]} THEN {value} END"


@query(f"""SELECT event_id, CASE stop {' '.join(f"WHEN {k} THEN '{n}'" for k, (n, _) in enumerate(_STOPS) if n)} END AS reject_reason, {_after('invalid_source_event_id', _s('$.id'))} AS source_event_id,
  {_after('invalid_origin_time', f"make_timestamp(try_cast({_s(_P + 'time')} AS BIGINT) * 1000)")} AS origin_time, {_after('invalid_source_updated_at', f"make_timestamp(try_cast({_s(_P + 'updated')} AS BIGINT) * 1000)")} AS source_updated_at,
  {_after('invalid_source_status', _s(_P + 'status'))} AS source_status, {_after('invalid_associated_ids', _IDS)} AS associated_ids, {_after('invalid_magnitude', f"try_cast({_s(_P + 'mag')} AS DOUBLE)")} AS magnitude,
  {_after('invalid_magnitude_type', _s(_P + 'magType'))} AS magnitude_type, {_after('invalid_place', _s(_P + 'place'))} AS place, {_after('placeholder_location', _XY[0])} AS longitude, {_after('placeholder_location', _XY[1])} AS latitude,
  {_after('invalid_depth_km', _XY[2])} AS depth_km FROM (SELECT *, CASE {' '.join(f'WHEN {c} THEN {k}' for k, (_, c) in enumerate(_STOPS))} ELSE {len(_STOPS)} END AS stop FROM (SELECT event_id, ({_FEATURE})::JSON AS j FROM events))""")  # fmt: skip
def typed_projection(spark, d):
    """One VARIANT feature to twelve fields and one of sixteen reasons [K1]."""
    features = _table(spark, d, "events").select("event_id", F.parse_json(F.expr(_FEATURE)).alias("payload"))
    out = project.project(features)
    return out.select("event_id", "reject_reason", "source_event_id", "origin_time", "source_updated_at", "source_status", F.array_join("associated_ids", ";").alias("associated_ids"), "magnitude", "magnitude_type", "place", "longitude", "latitude", "depth_km")


# ---- landing, windows, sweeps [A8, D13, I2, I7, K30]


@query(f"SELECT window_no::BIGINT AS window_no, k AS slice_no, s AS slice_start, least(s + INTERVAL 12 HOUR, window_end) AS slice_end FROM (SELECT *, unnest(range(window_start, window_end, INTERVAL 12 HOUR)) AS s, unnest(range(len(range(window_start, window_end, INTERVAL 12 HOUR)))) AS k FROM ({_MONTHS}))")
def hour_slices(spark, d):
    w = windows.slices(windows.history_windows(spark, CUTOFF), "hour", 12)
    return w.select(F.col("window_no").cast("long").alias("window_no"), F.col("slice_no").cast("long").alias("slice_no"), "slice_start", "slice_end")


@query("SELECT attempt_id, window_id, count(*) AS window_rows, count(DISTINCT fetched_at) AS fetch_times FROM obs GROUP BY 1, 2", "obs")
def rows_per_window(spark, d):
    return landing.window_counts(_obs(spark, d))


@query("""SELECT * FROM (SELECT 'rows lack metadata' AS problem, count_if(magnitude IS NULL)::BIGINT AS n FROM obs UNION ALL SELECT 'windows with several fetch times', count(*) FROM (SELECT 1 FROM obs GROUP BY window_id HAVING count(DISTINCT fetched_at) > 1)
  UNION ALL SELECT 'windows that no audit names', count(DISTINCT window_id) FROM obs WHERE window_id = 'w3' UNION ALL SELECT 'windows whose count differs', 1 + count(DISTINCT window_id) FROM obs WHERE window_id = 'w1') WHERE n > 0""", "obs")  # fmt: skip
def batch_file_problems(spark, d):
    """All observations as one attempt's file against an audit that lacks a window, miscounts one and has one too many [A8]."""
    obs = _obs(spark, d)
    rows = obs.select(F.lit("a").alias("attempt_id"), "window_id", "fetched_at", F.when(F.col("magnitude").isNotNull(), F.col("props")).alias("payload"), "payload_hash")
    told = obs.where("window_id <> 'w3'").groupBy("window_id").agg(F.count("*").alias("n")).select("window_id", (F.col("n") + (F.col("window_id") == "w1").cast("long")).alias("returned_rows"))
    audit = told.union(spark.range(1).select(F.lit("w9"), F.lit(5).cast("long"))).select(F.lit("a").alias("attempt_id"), "window_id", F.lit("reconciled").alias("window_status"), "returned_rows")
    return landing.batch_problems(rows, audit, "a")


_AUDIT = """SELECT 'o' || l_orderkey AS attempt_id, CASE WHEN l_orderkey % 29 = 0 AND l_linenumber = 2 THEN 'w1' ELSE 'w' || l_linenumber END AS window_id,
  CASE WHEN l_orderkey % 17 = 0 AND l_linenumber = 1 THEN 'unresolved' ELSE 'reconciled' END AS window_status, l_linenumber AS n,
  TIMESTAMP '2024-01-01' + {day}(l_linenumber - 1) + {hour}(CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = 3 THEN 1 WHEN l_orderkey % 23 = 0 AND l_linenumber = 2 THEN -1 ELSE 0 END) AS window_starttime,
  TIMESTAMP '2024-01-01' + {day}l_linenumber AS window_endtime, cast(l_linenumber AS bigint) AS count_before, cast(l_linenumber AS bigint) AS returned_rows,
  cast(CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 2 THEN NULL ELSE l_linenumber END AS bigint) AS count_after FROM {lines}"""
_DUCK_AUDIT = _AUDIT.replace("{day}(l_linenumber - 1)", "to_days((l_linenumber - 1)::INTEGER)").replace("{day}l_linenumber", "to_days(l_linenumber::INTEGER)").replace("{hour}(", "to_hours((").replace("ELSE 0 END) AS window_starttime", "ELSE 0 END)::INTEGER) AS window_starttime").replace("{lines}", "lineitem")


@query(f"""WITH audit AS ({_DUCK_AUDIT}), requests AS (SELECT attempt_id, TIMESTAMP '2024-01-01' AS low, TIMESTAMP '2024-01-01' + to_days((max(n) + CASE WHEN substr(attempt_id, 2)::BIGINT % 11 = 0 THEN 1 ELSE 0 END)::INTEGER) AS cutoff FROM audit GROUP BY 1),
  counts AS (SELECT attempt_id, CASE WHEN substr(attempt_id, 2)::BIGINT % 31 = 0 AND n = 1 THEN 'stray' ELSE window_id END AS window_id, sum(returned_rows + CASE WHEN substr(attempt_id, 2)::BIGINT % 19 = 0 AND n = 1 THEN 1 ELSE 0 END)::BIGINT AS window_rows FROM audit GROUP BY 1, 2),
  leaves AS (SELECT a.*, r.low, c.window_rows, coalesce(lag(window_endtime) OVER (PARTITION BY a.attempt_id ORDER BY window_starttime, window_endtime, a.window_id), r.low) AS before FROM audit a JOIN requests r USING (attempt_id) LEFT JOIN counts c ON c.attempt_id = a.attempt_id AND c.window_id = a.window_id WHERE window_status = 'reconciled'),
  s AS (SELECT attempt_id, count(*) AS leaves, count_if(window_starttime <> before OR window_endtime <= window_starttime) AS breaks, max(window_endtime) AS upto, count_if(count_before IS DISTINCT FROM returned_rows OR returned_rows IS DISTINCT FROM count_after) AS unequal_counts,
    count(*) - count(DISTINCT window_id) AS repeated_windows, count_if(coalesce(window_rows, 0) <> returned_rows) AS differing_rows FROM leaves GROUP BY 1),
  u AS (SELECT attempt_id, count_if(window_status NOT IN ('reconciled', 'split')) AS unsettled FROM audit GROUP BY 1),
  st AS (SELECT attempt_id, count(*) AS stray_windows FROM counts c WHERE NOT EXISTS (SELECT 1 FROM leaves l WHERE l.attempt_id = c.attempt_id AND l.window_id = c.window_id) GROUP BY 1),
  j AS (SELECT r.attempt_id, r.cutoff, s.upto, coalesce(leaves, 0) AS leaves, coalesce(breaks, 0) AS breaks, coalesce(unsettled, 0) AS unsettled, coalesce(unequal_counts, 0) AS unequal_counts, coalesce(repeated_windows, 0) AS repeated_windows, coalesce(differing_rows, 0) AS differing_rows, coalesce(stray_windows, 0) AS stray_windows
    FROM requests r LEFT JOIN s USING (attempt_id) LEFT JOIN u USING (attempt_id) LEFT JOIN st USING (attempt_id))
  SELECT attempt_id, leaves, breaks, unsettled, unequal_counts, repeated_windows, differing_rows, stray_windows, CASE WHEN unsettled > 0 OR leaves = 0 THEN 'unsettled windows' WHEN breaks > 0 OR upto IS DISTINCT FROM cutoff THEN 'range not covered'
    WHEN unequal_counts > 0 OR repeated_windows > 0 THEN 'counts disagree' WHEN differing_rows > 0 OR stray_windows > 0 THEN 'rows differ' ELSE 'complete' END AS sweep_state FROM j""")  # fmt: skip
def sweep_coverage(spark, d):
    """Sweeps with gaps, overlaps, open ends, unsettled and repeated windows, miscounts and stray rows [I7]."""
    day, hour = "make_dt_interval(", "make_dt_interval(0, "
    text = _AUDIT.replace("{day}(l_linenumber - 1)", f"{day}l_linenumber - 1)").replace("{day}l_linenumber", f"{day}l_linenumber)").replace("{hour}(", hour)
    lines = _table(spark, d, "lineitem").select(F.col("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"))
    audit, tasks = spark.sql(text, lines=lines), sweeps.tasks_for(spark, lines.count())
    dealt = audit.repartition(tasks, "attempt_id")  # both groupings rest on it
    no = F.substring("attempt_id", 2, 20).cast("long")
    low = F.lit("2024-01-01").cast("timestamp")
    requests = dealt.groupBy("attempt_id").agg(F.max("n").alias("n")).select("attempt_id", low.alias("low"), (low + F.make_dt_interval(F.col("n") + (no % 11 == 0).cast("int"))).alias("cutoff"))
    first = F.col("n") == 1
    counts = dealt.groupBy("attempt_id", F.when((no % 31 == 0) & first, "stray").otherwise(F.col("window_id")).alias("window_id")).agg(F.sum(F.col("returned_rows") + ((no % 19 == 0) & first).cast("long")).alias("window_rows"))
    return sweeps.coverage(audit.drop("n"), requests, counts, tasks)


@query(f"""SELECT window_no::BIGINT AS window_no, coalesce(c.captures, 0) AS captures, c.file FROM ({_MONTHS}) w LEFT JOIN (SELECT n, count(*) AS captures, max(file) AS file FROM (SELECT 1 + o_orderkey % 180 AS n, 'c' || o_orderkey AS file FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 180 % 12 <> 5) GROUP BY 1) c ON c.n = w.window_no""")
def capture_inventory(spark, d):
    """Planned windows with their complete captures; ranges that differ by a second are other windows [K30]."""
    planned = windows.history_windows(spark, CUTOFF)
    key = F.col("o_orderkey")
    made = _table(spark, d, "orders").select((1 + key % 180).cast("int").alias("window_no"), key).join(F.broadcast(planned), "window_no")
    late = F.when(key % 180 % 12 == 5, F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))).otherwise(F.make_dt_interval())
    captures = made.select("site_key", "window_start", (F.col("window_end") + late).alias("window_end"), ((key % 4 != 0) & (key % 3 != 0)).alias("complete"), F.concat(F.lit("c"), key).alias("file"))
    return inventory.captured(planned, captures).select(F.col("window_no").cast("long").alias("window_no"), "captures", "file")


# ---- re-keying, deletes, relabelling [A19, K7, K25]


@query("SELECT attempt_id, attempt_no FROM att WHERE attempt_no % 13 = 0 OR attempt_no % 5 = 0", "att")
def delete_rows(spark, d):
    """Loaded attempts go by key; how many is known before [A19]."""
    rows = adapter.attempts(spark, d).select("attempt_id", "attempt_no", "load_status")
    gone = rows.where("load_status = 'complete' AND attempt_no % 5 <> 0").select("attempt_id")
    return merge.delete(rows, gone, ["attempt_id"]).select("attempt_id", "attempt_no")


_REKEY = """SELECT * FROM (WITH f AS (SELECT *, canonical_event_id AS source_event_id FROM facts), m AS (SELECT DISTINCT source_event_id, 'g' || (substr(source_event_id, 2)::BIGINT // 3) AS new_id FROM f WHERE substr(source_event_id, 2)::BIGINT % 50 <> 7),
  x AS (SELECT f.canonical_event_id, f.source_updated_at, f.event_type AS payload_hash, f.fetched_at, f.stage_file_name, f.stage_file_row_number, m.new_id FROM f LEFT JOIN m USING (source_event_id)),
  b AS (SELECT canonical_event_id, source_updated_at, event_type AS payload_hash, site_key FROM f CROSS JOIN sites WHERE NOT (substr(canonical_event_id, 2)::BIGINT % 4 = 0 AND site_key = 'seattle')
    UNION ALL SELECT canonical_event_id, source_updated_at, event_type, 'anchorage' FROM f WHERE substr(canonical_event_id, 2)::BIGINT % 9 = 0
    UNION ALL SELECT 'x' || canonical_event_id, source_updated_at, event_type, 'seattle' FROM f WHERE substr(canonical_event_id, 2)::BIGINT % 25 = 0),
  k AS (SELECT canonical_event_id, source_updated_at, payload_hash, min(new_id) AS new_id, min(rk) AS rk, max(met) AS met FROM (SELECT *, row_number() OVER (PARTITION BY new_id, source_updated_at, payload_hash ORDER BY fetched_at DESC, stage_file_name DESC, stage_file_row_number DESC, canonical_event_id DESC) AS rk,
      count(*) OVER (PARTITION BY new_id, source_updated_at, payload_hash) AS met FROM x WHERE new_id IS NOT NULL) GROUP BY 1, 2, 3),
  p AS (SELECT b.*, k.new_id, k.rk FROM b LEFT JOIN k ON k.canonical_event_id = b.canonical_event_id AND k.source_updated_at = b.source_updated_at AND k.payload_hash = b.payload_hash),
  c AS (SELECT 'no canonical id' AS problem, count_if(new_id IS NULL) AS n FROM x UNION ALL SELECT 'one id in two groups', count_if(lo <> hi) FROM (SELECT min(new_id) AS lo, max(new_id) AS hi FROM x GROUP BY canonical_event_id)
    UNION ALL SELECT 'repeated fact key', count(*) FROM (SELECT 1 FROM x GROUP BY canonical_event_id, source_updated_at, payload_hash HAVING count(*) > 1) UNION ALL SELECT 'bridge without a fact', count_if(rk IS NULL) FROM p
    UNION ALL SELECT 'repeated bridge key', count(*) FROM (SELECT 1 FROM p GROUP BY canonical_event_id, source_updated_at, payload_hash, site_key HAVING count(*) > 1)
    UNION ALL SELECT 'bridges collide', count(*) FROM (SELECT 1 FROM p WHERE rk = 1 GROUP BY new_id, source_updated_at, payload_hash, site_key HAVING count(DISTINCT canonical_event_id) > 1)
    UNION ALL SELECT 'winner lacks a site', count_if(n < 3) FROM (SELECT (SELECT count(DISTINCT site_key) FROM b WHERE b.canonical_event_id = k.canonical_event_id AND b.source_updated_at = k.source_updated_at AND b.payload_hash = k.payload_hash) AS n FROM k WHERE rk = 1 AND met > 1))
  SELECT problem, n::BIGINT AS n FROM c WHERE n > 0)"""


@query(_REKEY, "facts", "sites")
def rekey_stops(spark, d):
    """Facts and bridges with planted faults: each kind is counted before anything moves [K7]."""
    n = F.substring("canonical_event_id", 2, 20).cast("long")
    facts = _facts(spark, d).withColumns({"source_event_id": F.col("canonical_event_id"), "payload_hash": F.col("event_type")})
    own = F.transform(F.array(*(F.lit(k) for k, *_ in SITES)), lambda site: F.struct(F.col("canonical_event_id").alias("id"), site.alias("site")))
    placed = F.filter(own, lambda x: ~((n % 4 == 0) & (x["site"] == "seattle")))
    planted = F.array(F.when(n % 9 == 0, F.struct(F.col("canonical_event_id").alias("id"), F.lit("anchorage").alias("site"))), F.when(n % 25 == 0, F.struct(F.concat(F.lit("x"), "canonical_event_id").alias("id"), F.lit("seattle").alias("site"))))
    bridges = facts.select("source_updated_at", "payload_hash", F.inline(F.array_compact(F.concat(placed, planted)))).select(F.col("id").alias("canonical_event_id"), "source_updated_at", "payload_hash", F.col("site").alias("site_key"))
    mapping = facts.select("source_event_id").distinct().withColumn("no", F.substring("source_event_id", 2, 20).cast("long")).where("no % 50 <> 7").select("source_event_id", F.expr("'g' || (no div 3)").alias("canonical_id"))
    return revisions.rekey_problems(facts, bridges, mapping)


@query("SELECT event_id, CASE WHEN reject_reason = 'invalid_geometry' AND event_id % 2 = 0 THEN 'source_stub_record' ELSE reject_reason END AS reject_reason, reject_reason = 'invalid_geometry' AND event_id % 2 = 0 AS relabelled FROM (SELECT event_id, coalesce(reject_reason, 'none') AS reject_reason FROM obs)", "obs")
def parser_relabel(spark, d):
    """Rejects of the old reason whose RAW payload is a stub get the new one, by a join on the file row [K25]."""
    rows = _obs(spark, d).select("stage_file_name", "stage_file_row_number", "event_id", F.coalesce("reject_reason", F.lit("none")).alias("reject_reason"))
    text = F.when(F.col("event_id") % 2 == 0, '{"properties":{"time":null}}').otherwise('{"properties":{"time":1,"mag":null}}')
    raw = rows.select("stage_file_name", "stage_file_row_number", F.parse_json(text).alias("payload"))
    return migrate.relabelled(rows, raw, "invalid_geometry", "source_stub_record", migrate.is_stub()).select("event_id", "reject_reason", "relabelled")


# ---- reports and verdicts [K17, K18, K21, K26]


@query("SELECT attempt_id, window_id, stage_file_name, stage_file_row_number, canonical_event_id AS source_event_id, reject_reason, fetched_at AS projected_at FROM obs WHERE reject_reason IS NOT NULL", "obs")
def event_rejects(spark, d):
    return views.rejects(_obs(spark, d).withColumns({"source_event_id": F.col("canonical_event_id"), "projected_at": F.col("fetched_at")}))


@query("SELECT attempt_id, health_status, loaded_rows, raw_rows, staging_rows, processed_rows, rejected_rows, receipt_gap_count FROM health WHERE health_status NOT IN ('RECONCILED', 'PENDING_PROCESS')", "health")
def batch_anomalies(spark, d):
    return views.batch_anomalies(_health(spark, d))


_WINDOW_AUDIT = "SELECT 'o' || l_orderkey AS attempt_id, 'w' || l_linenumber AS window_id, CASE WHEN l_linenumber % 5 = 0 THEN 'unresolved' ELSE 'reconciled' END AS window_status, l_linenumber::BIGINT AS count_before, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linenumber::BIGINT END AS returned_rows, CASE WHEN l_linenumber = 2 AND l_orderkey % 7 = 0 THEN 3 ELSE l_linenumber::BIGINT END AS count_after FROM lineitem"


def _audits(spark, d, lines=None):
    n = F.col("l_linenumber")
    item = F.struct(
        F.concat(F.lit("w"), n).alias("window_id"), F.when(n % 5 == 0, "unresolved").otherwise("reconciled").alias("status"), n.alias("count_before"), F.when(n % 3 != 0, n).alias("returned_rows"),
        F.when((n == 2) & (F.col("l_orderkey") % 7 == 0), 3).otherwise(n).alias("count_after"),
    )
    rows = _table(spark, d, "lineitem") if lines is None else lines
    receipts = rows.groupBy("l_orderkey").agg(F.parse_json(F.to_json(F.collect_list(item))).alias("window_audit"))
    return views.window_audit(receipts.select(F.concat(F.lit("o"), "l_orderkey").alias("attempt_id"), F.lit("origin").alias("batch_kind"), "window_audit"))


@query(f"SELECT * FROM ({_WINDOW_AUDIT}) WHERE window_status = 'unresolved' OR (count_before IS NOT NULL AND returned_rows IS NOT NULL AND count_after IS NOT NULL AND (count_before <> returned_rows OR returned_rows <> count_after))")
def window_anomalies(spark, d):
    return views.window_anomalies(_audits(spark, d)).select("attempt_id", "window_id", "window_status", "count_before", "returned_rows", "count_after")


@query("SELECT site_key, count(*) AS current_events_within_radius, min(magnitude) AS min_magnitude, max(magnitude) AS max_magnitude, min(origin_time) AS earliest_origin, max(origin_time) AS latest_origin FROM cur JOIN bridge USING (canonical_event_id, source_updated_at, payload_hash) WHERE site_key = 'seattle' AND within_radius AND origin_time >= TIMESTAMP '2024-01-01' AND origin_time < TIMESTAMP '2024-01-02' GROUP BY 1", "cur", "bridge")
def day_sample(spark, d):
    start, end = (F.lit(x).cast("timestamp") for x in ("2024-01-01", "2024-01-02"))
    return views.day_sample(_current(spark, d), _bridge(spark, d), SITES[0][0], start, end)


@query(f"""SELECT batch_anomalies, health_rejects, window_anomalies, view_rejects, duplicate_facts, duplicate_bridge, CASE WHEN attempts > 0 AND other = 0 AND window_anomalies = 0 AND health_rejects = view_rejects AND duplicate_facts = 0 AND duplicate_bridge = 0 THEN 'pass' ELSE 'review' END AS verdict FROM (
  SELECT (SELECT count_if(health_status NOT IN ('RECONCILED', 'PENDING_PROCESS')) FROM health) AS batch_anomalies, (SELECT count_if(health_status <> 'RECONCILED') FROM health) AS other, (SELECT count(*) FROM health) AS attempts, (SELECT coalesce(sum(rejected_rows), 0)::BIGINT FROM health) AS health_rejects,
    (SELECT count(*) FROM ({_WINDOW_AUDIT}) WHERE window_status = 'unresolved' OR count_before <> returned_rows OR returned_rows <> count_after) AS window_anomalies, (SELECT count(*) FROM obs WHERE reject_reason IS NOT NULL) AS view_rejects,
    (SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY {KEY} HAVING count(*) > 1)) AS duplicate_facts, (SELECT count(*) FROM (SELECT 1 FROM bridge GROUP BY {KEY}, site_key HAVING count(*) > 1)) AS duplicate_bridge)""", "health", "facts", "bridge")  # fmt: skip
def run_verdict(spark, d):
    """Rejects of the health view against those of the rejects view, anomalies and repeated keys [K26]."""
    scratch = Scratch(spark, "verdict")
    lines = _lines(spark, d, scratch)
    staged = scratch.cut(_obs(spark, d).drop("props").withColumns({"source_event_id": F.col("canonical_event_id"), "projected_at": F.col("fetched_at")}), "staged")
    facts = revisions.dedup(staged.where("reject_reason IS NULL"))
    stored = {"facts": (facts, REVISION_KEY), "bridge": (geo.bridge(facts), (*REVISION_KEY, "site_key"))}
    return checks.verdict(_health(spark, d, lines), views.window_anomalies(_audits(spark, d, lines)), stored, views.rejects(staged))


# ---- briefs [J6, J8]

_SITE_NAME = "CASE site_key " + " ".join(f"WHEN '{k}' THEN '{n}'" for k, n, *_ in SITES) + " END"
_GIVEN = {
    "site": "site_name", "event count": "event_count || ' events'", "radius": "'250 km'", "event ID": "nearest_event_id", "distance": "nearest_distance_km || ' km from ' || site_name", "magnitude": "'magnitude ' || nearest_magnitude",
    "source status": "nearest_source_status", "record age": "nearest_record_age_hours || ' hours'", "sample scope": "'modeled'",
}
_BRIEF = "'In the modeled ' || site_name || ' sample ' || event_count || ' events were within 250 km; the nearest event ' || nearest_event_id || ' was ' || nearest_distance_km || ' km from ' || site_name || ', magnitude ' || nearest_magnitude || ', source status ' || nearest_source_status || ', and its source record was ' || nearest_record_age_hours || ' hours old.'"
#: Ways in which a brief is turned wrong; the first leaves it as it is.
_WAYS = (("whole", "{b}"), ("no end", "rtrim({b}, '.')"), ("hazard", "{b} || ' You should take Shelter.'"), ("coverage", "{b} || ' This is complete source coverage.'"), ("anchor", "{b} || ' Far away from  ' || upper(nearest_event_id) || '.'"), ("count", "replace({b}, ' events', '0 events')"), ("status", "replace({b}, 'source status', 'state')"), ("site", "replace({b}, ' km from ', ' km off ')"))


def _missing(name: str, value: str) -> str:
    return f"CASE WHEN NOT coalesce(contains(low, lower({value})), FALSE) THEN 'missing or misstated {name}' END"


def _brief_sql() -> str:
    """The twin rests on the query of the aggregates, whose twin it takes as its input."""
    from revisio.plans.registry import SQL

    ways = " UNION ALL ".join(f"SELECT case_id, '{name}' AS way, {text.format(b=_BRIEF)} AS message, * EXCLUDE (case_id) FROM named" for name, text in _WAYS)
    tests = ", ".join(_missing(n, v) for n, v in _GIVEN.items())
    return f"""WITH cases AS ({SQL["site_window_aggregates"]}), named AS (SELECT * REPLACE (round(nearest_magnitude, 2) AS nearest_magnitude), {_SITE_NAME} AS site_name FROM cases WHERE event_count > 0), said AS (SELECT *, replace(lower(message), ',', '') AS low FROM ({ways}))
  SELECT case_id, way, array_to_string(list_filter([{tests}, CASE WHEN regexp_matches(low, '\\b(risk|shaking|damage|evacuat\\w*|shelter|safe|danger|should|alert)\\b') THEN 'hazard or action language' END, CASE WHEN regexp_matches(low, '\\b(complete|all|every|guaranteed)\\s+(source\\s+)?coverage\\b') THEN 'unsupported coverage claim' END,
    CASE WHEN contains(regexp_replace(low, '\\s+', ' ', 'g'), 'away from ' || lower(nearest_event_id)) THEN 'distance anchored to event ID' END, CASE WHEN NOT ends_with(rtrim(message), '.') THEN 'incomplete ending' END], lambda x: x IS NOT NULL), '; ') AS problems FROM said"""


@query(_brief_sql())
def brief_screen(spark, d):
    """The template's brief of each case with events, whole and turned wrong in seven ways, before the nine facts and four rules [J6]."""
    cases = QUERIES["site_window_aggregates"](spark, d).where("event_count > 0").withColumn("nearest_magnitude", F.round("nearest_magnitude", 2)).withColumn("brief", briefs.template())
    way = F.array(*(F.struct(F.lit(name).alias("way"), F.expr(text.format(b="brief")).alias("message")) for name, text in (*_WAYS[:1], ("no end", "rtrim('.', {b})"), *_WAYS[2:])))
    said = cases.select("*", F.inline(way))
    return said.select("case_id", "way", F.array_join(briefs.problems(F.col("message")), "; ").alias("problems"))


def _aggregate_sql() -> str:
    from revisio.plans.registry import SQL

    return f"""WITH c AS ({SQL["site_window_aggregates"]}), bad AS (SELECT CASE WHEN case_id = 'seattle-2' THEN 'seattle-1' ELSE case_id END AS case_id, CASE WHEN case_id = 'anchorage-0' THEN 'nome' ELSE site_key END AS site_key, CASE WHEN case_id = 'anchorage-1' THEN 100e0 ELSE radius_km END AS radius_km, distinct_radii,
    CASE WHEN case_id = 'san-francisco-0' THEN -1 ELSE event_count END AS event_count, CASE WHEN case_id = 'san-francisco-1' THEN NULL ELSE nearest_event_id END AS nearest_event_id FROM c WHERE case_id <> 'san-francisco-2' UNION ALL SELECT 'extra', 'seattle', 250e0, 1, 0, 'u1')
  SELECT case_id, problem FROM (SELECT case_id, unnest([CASE WHEN case_id = 'extra' THEN 'unknown case' END, CASE WHEN site_key NOT IN ('seattle', 'san-francisco', 'anchorage') THEN 'unknown site' END, CASE WHEN radius_km <> 250 OR distinct_radii <> 1 THEN 'radius' END, CASE WHEN event_count < 0 THEN 'count' END,
    CASE WHEN event_count = 0 AND nearest_event_id IS NOT NULL THEN 'nearest event of none' END, CASE WHEN event_count > 0 AND nearest_event_id IS NULL THEN 'no nearest event' END]) AS problem FROM bad UNION ALL SELECT case_id, 'repeated case' FROM bad GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT 'seattle-2', 'absent' UNION ALL SELECT 'san-francisco-2', 'absent') WHERE problem IS NOT NULL"""


@query(_aggregate_sql())
def aggregate_problems(spark, d):
    """The nine aggregates with a fault of each kind [J8]."""
    c, at = QUERIES["site_window_aggregates"](spark, d), F.col("case_id")
    bad = c.where(at != "san-francisco-2").select(
        F.when(at == "seattle-2", "seattle-1").otherwise(at).alias("case_id"), F.when(at == "anchorage-0", "nome").otherwise(F.col("site_key")).alias("site_key"), F.when(at == "anchorage-1", 100.0).otherwise(F.col("radius_km")).alias("radius_km"), "distinct_radii",
        F.when(at == "san-francisco-0", -1).otherwise(F.col("event_count")).alias("event_count"), F.when(at != "san-francisco-1", F.col("nearest_event_id")).alias("nearest_event_id"),
    )
    extra = spark.sql("SELECT 'extra' AS case_id, 'seattle' AS site_key, 250D AS radius_km, 1L AS distinct_radii, 0L AS event_count, 'u1' AS nearest_event_id")
    return briefs.aggregate_problems(bad.union(extra), [f"{s[0]}-{y}" for s in SITES for y in range(3)])
