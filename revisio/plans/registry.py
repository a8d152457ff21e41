"""Named queries over the driver's tables, each with its SQL twin.

Spark queries use the operators of this package or, for plain relational forms, Spark SQL
over frames. The twins are written for the same adapter (`sources.adapter`).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revisio.functions import geo
from revisio.operators import aliases, merge, revisions, selection, views, windows
from revisio.plans.lineage import Scratch
from revisio.schema import EARTH_RADIUS_KM, RADIUS_KM, REVISION_KEY, SITES
from revisio.sources import adapter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = "2026-10-01 00:00:00"
CUTOFF = datetime(2026, 9, 29, tzinfo=UTC)
KEY = ", ".join(REVISION_KEY)

# ---- SQL of the adapter and the models, as common table expressions
_SITE_ROWS = ", ".join(f"('{k}', '{n}', {la}e0, {lo}e0, {RADIUS_KM}e0)" for k, n, la, lo in SITES)
_CTE = {
    "obs": (adapter.text(adapter.OBSERVATIONS, "duck", events="events"), ()),
    "acc": ("SELECT * FROM obs WHERE reject_reason IS NULL", ("obs",)),
    "facts": (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY fetched_at DESC, stage_file_name DESC, stage_file_row_number DESC) AS rn FROM acc) WHERE rn = 1", ("acc",)),
    "cur": ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY canonical_event_id ORDER BY source_updated_at DESC, fetched_at DESC, payload_hash DESC, stage_file_name DESC, stage_file_row_number DESC) AS rn FROM facts) WHERE rn = 1 AND source_status <> 'deleted'", ("facts",)),
    "sites": (f"SELECT * FROM (VALUES {_SITE_ROWS}) s(site_key, site_name, site_latitude, site_longitude, radius_km)", ()),
    "dist": (f"""SELECT f.*, s.site_key, s.radius_km, CASE WHEN latitude IS NULL AND longitude IS NULL THEN NULL ELSE 2 * {EARTH_RADIUS_KM}e0 * asin(sqrt(least(1.0, greatest(0.0,
        pow(sin(radians(site_latitude - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(site_latitude)) * pow(sin(radians(site_longitude - longitude) / 2), 2))))) END AS epicentral_distance_km FROM facts f CROSS JOIN sites s""", ("facts", "sites")),
    "bridge": (f"SELECT {KEY}, site_key, epicentral_distance_km, epicentral_distance_km <= radius_km AS within_radius FROM dist", ("dist",)),
    "cases": ("""SELECT site_key || '-' || y AS case_id, site_key, make_timestamp(2024, 1 + 3 * y, 1, 0, 0, 0.0) AS start_utc, make_timestamp(2024, 4 + 3 * y, 1, 0, 0, 0.0) AS end_utc
        FROM sites CROSS JOIN (SELECT 0 AS y UNION ALL SELECT 1 UNION ALL SELECT 2) ys""", ("sites",)),
    "att": (adapter.text(adapter.ATTEMPTS, "duck", orders="orders", lineitem="lineitem"), ()),
    "proc": (adapter.text(adapter.PROCESSES, "duck", attempts="att"), ("att",)),
    "latest": ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY attempt_id ORDER BY finished_second DESC, process_attempt_id DESC) AS rn FROM proc) WHERE rn = 1", ("proc",)),
    "health": ("""SELECT a.attempt_id, a.batch_kind, a.loaded_rows, coalesce(r.n, 0) AS raw_rows, coalesce(r.n, 0) AS staging_rows, coalesce(r.j, 0) AS staging_reject_rows, p.processed_rows, p.rejected_rows, a.gap_count AS receipt_gap_count,
        f.seconds AS fetch_to_curated_seconds, a.fetched_at,
        CASE WHEN a.gap_count > 0 THEN 'SOURCE_GAP' WHEN a.load_status <> 'complete' THEN 'LOAD_INCOMPLETE'
          WHEN a.source_rows_returned IS NULL OR a.source_rows_returned <> a.raw_rows_written OR a.raw_rows_written <> a.loaded_rows OR a.loaded_rows <> coalesce(r.n, 0) THEN 'RAW_COUNT_MISMATCH'
          WHEN p.process_attempt_id IS NULL THEN 'PENDING_PROCESS' WHEN p.status <> 'complete' THEN 'PROCESS_FAILED'
          WHEN f.attempt_id IS NULL OR p.loaded_rows <> a.loaded_rows OR p.processed_rows <> p.loaded_rows OR p.rejected_rows > p.processed_rows OR coalesce(r.n, 0) <> p.loaded_rows OR coalesce(r.j, 0) <> p.rejected_rows
            OR f.processed_rows <> p.processed_rows OR f.rejected_rows <> p.rejected_rows THEN 'PROCESS_COUNT_MISMATCH' ELSE 'RECONCILED' END AS health_status
        FROM att a LEFT JOIN (SELECT 'o' || l_orderkey AS attempt_id, count(*) AS n, count_if(l_linenumber = 7) AS j FROM lineitem GROUP BY 1) r ON r.attempt_id = a.attempt_id
        LEFT JOIN latest p ON p.attempt_id = a.attempt_id
        LEFT JOIN (SELECT attempt_id, processed_rows, rejected_rows, cast(finished_second * 1000 + attempt_no % 997 AS DOUBLE) AS seconds FROM latest WHERE status = 'complete') f ON f.attempt_id = a.attempt_id""", ("att", "latest")),
}


def _sql(body: str, *names: str) -> str:
    """The body under the expressions it needs, in order."""
    need: list[str] = []

    def add(n: str) -> None:
        for d in _CTE[n][1]:
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    return ("WITH " + ", ".join(f"{n} AS ({_CTE[n][0]})" for n in need) + " " if need else "") + body


def query(sql: str | None = None, *names: str):
    """Register a query under its function's name. Instants leave as NTZ (UTC)."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = _sql(sql, *names)
        return f

    return add


# ---- frames that several queries share
_obs, _acc, _table = adapter.observations, adapter.accepted, adapter.table


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return revisions.dedup(_acc(spark, d))


def _current(spark: SparkSession, d: str) -> DataFrame:
    return revisions.current(_facts(spark, d))


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    return geo.bridge(_facts(spark, d))


def _cases(spark: SparkSession) -> DataFrame:
    """Nine literal cases: three sites, three quarters [A14]."""
    rows = [(f"{s[0]}-{y}", s[0], f"2024-{1 + 3 * y:02}-01", f"2024-{4 + 3 * y:02}-01") for s in SITES for y in range(3)]
    return spark.createDataFrame(rows, "case_id string, site_key string, s string, e string").select("case_id", "site_key", F.to_timestamp("s").alias("start_utc"), F.to_timestamp("e").alias("end_utc"))


def _attempts(spark: SparkSession, d: str, scratch: Scratch, lines: DataFrame | None = None) -> DataFrame:
    """Attempts as a stored table, so that what joins them several times does not derive them again."""
    return scratch.cut(adapter.attempts(spark, d, lines), "attempts")


def _lines(spark: SparkSession, d: str, scratch: Scratch) -> DataFrame:
    """Two columns of lineitem, stored for several readers."""
    return scratch.cut(_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "lines")


def _health(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """Batch health over stored attempts and counts, process rows and batch facts, by its four left joins [C4, K15]."""
    scratch = Scratch(spark, "health")
    lines = _table(spark, d, "lineitem") if lines is None else lines
    attempts = _attempts(spark, d, scratch, lines)
    processes = adapter.processes(spark, d, attempts)
    done = views.latest_process(processes, "finished_second").where("status = 'complete'")
    seconds = F.col("finished_second") * 1000 + F.substring("attempt_id", 2, 20).cast("long") % 997
    facts = done.select("attempt_id", F.col("status").alias("process_status"), "processed_rows", "rejected_rows", seconds.cast("double").alias("fetch_to_curated_seconds"))
    by_attempt = lines.groupBy(F.concat(F.lit("o"), F.col("l_orderkey")).alias("attempt_id"))
    counts = scratch.cut(by_attempt.agg(F.count("*").alias("rows"), F.count_if(F.col("l_linenumber") == 7).alias("staging_reject_rows")), "counts")
    return views.batch_health(attempts, counts.select("attempt_id", F.col("rows").alias("raw_rows")), counts.select("attempt_id", F.col("rows").alias("staging_rows"), "staging_reject_rows"), processes, facts, F.col("gap_count"), "finished_second")


def _near(spark: SparkSession, d: str) -> DataFrame:
    """Current events with each site whose radius they are in: the bridge follows from the fact row, so that nothing is joined but the three sites."""
    return geo.measured(_current(spark, d)).where("within_radius")


def _matched(spark: SparkSession, d: str) -> DataFrame:
    """Current events of each case's site and quarter, one row per event and case [C1-C3, E3]."""
    at = _near(spark, d).join(F.broadcast(_cases(spark)), "site_key").where((F.col("origin_time") >= F.col("start_utc")) & (F.col("origin_time") < F.col("end_utc")))
    first = Window.partitionBy("case_id", "canonical_event_id").orderBy(F.col("source_updated_at").desc(), F.col("payload_hash").desc(), "epicentral_distance_km")
    return at.withColumn("dedup_rank", F.row_number().over(first)).where("dedup_rank = 1")


_MATCHED = "SELECT c.case_id, e.*, b.epicentral_distance_km FROM cases c JOIN bridge b ON b.site_key = c.site_key AND b.within_radius JOIN cur e USING (canonical_event_id, source_updated_at, payload_hash) WHERE e.origin_time >= c.start_utc AND e.origin_time < c.end_utc"


# ---- projections and predicates [A10, B*]
@query("SELECT event_id, cast(json_extract(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') IS NULL AS k_missing FROM events")
def path_projection(spark, d):
    v = F.try_parse_json("props")
    return _table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.variant_get(v, "$.k", "variant").isNull().alias("k_missing"))


@query("SELECT event_id, position, cast(item AS BIGINT) AS item FROM (SELECT event_id, unnest(range(event_id % 4)) AS position, unnest(list_transform(range(event_id % 4), lambda x: x * x)) AS item FROM events)")
def variant_unnest(spark, d):
    """An inner unnest: empty arrays drop their row."""
    arrays = _table(spark, d, "events").select("event_id", F.parse_json(F.to_json(F.transform(F.sequence(F.lit(0), (F.col("event_id") % 4).cast("int")), lambda x: x * x))).alias("v"))
    return spark.sql("SELECT event_id, cast(x.pos AS bigint) AS position, cast(x.value AS bigint) AS item FROM {a}, LATERAL variant_explode(v) x WHERE x.pos < event_id % 4", a=arrays)


@query("SELECT event_id, origin_time FROM obs WHERE fetched_at >= TIMESTAMP '2024-01-05' AND fetched_at < TIMESTAMP '2024-01-20'", "obs")
def half_open_range(spark, d):
    ts = F.col("ts").cast("timestamp_ntz")
    low, high = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")
    return _table(spark, d, "events").where((F.col("ts") >= low) & (F.col("ts") < high)).select("event_id", F.date_trunc("month", ts).alias("origin_time"))


@query("SELECT source_status, count(*) AS n FROM obs WHERE source_status IN ('reviewed', 'automatic') AND reject_reason NOT IN ('source_stub_record') GROUP BY 1", "obs")
def in_not_in(spark, d):
    return _obs(spark, d).where(F.col("source_status").isin("reviewed", "automatic") & ~F.col("reject_reason").isin("source_stub_record")).groupBy("source_status").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 7)")
def semi_join(spark, d):
    lines = _table(spark, d, "lineitem").where("l_linenumber = 7")
    return _table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join(spark, d):
    return _table(spark, d, "orders").join(_table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT event_id, CASE WHEN magnitude IS NULL THEN 'none' WHEN magnitude < 1 THEN 'low' WHEN magnitude < 10 THEN 'mid' ELSE 'high' END AS band, CASE WHEN longitude IS NULL THEN 0 ELSE 1 END AS located, coalesce(reject_reason, 'ok') AS reason FROM obs", "obs")
def case_iff_coalesce(spark, d):
    m = F.col("magnitude")
    return _obs(spark, d).select("event_id", F.when(m.isNull(), "none").when(m < 1, "low").when(m < 10, "mid").otherwise("high").alias("band"), F.when(F.col("longitude").isNull(), 0).otherwise(1).alias("located"), F.coalesce("reject_reason", F.lit("ok")).alias("reason"))


@query("SELECT c.case_id, count(*) AS n FROM cases c JOIN bridge b ON b.site_key = c.site_key AND b.within_radius GROUP BY 1", "cases", "bridge")
def inline_values_join(spark, d):
    return _bridge(spark, d).where("within_radius").join(F.broadcast(_cases(spark)), "site_key").groupBy("case_id").agg(F.count("*").alias("n"))


# ---- joins [C*]
@query(f"SELECT {KEY}, site_key, round(epicentral_distance_km, 3) AS km, origin_time FROM cur JOIN bridge USING ({KEY})", "cur", "bridge")
def composite_inner_join(spark, d):
    return _current(spark, d).join(_bridge(spark, d), list(REVISION_KEY)).select(*REVISION_KEY, "site_key", F.round("epicentral_distance_km", 3).alias("km"), "origin_time")


@query("SELECT c.case_id, e.canonical_event_id FROM cases c JOIN bridge b ON b.site_key = c.site_key AND b.within_radius JOIN cur e USING (canonical_event_id, source_updated_at, payload_hash) WHERE e.origin_time >= c.start_utc AND e.origin_time < c.end_utc", "cases", "bridge", "cur")
def equi_range_join(spark, d):
    return _matched(spark, d).select("case_id", "canonical_event_id")


@query("SELECT a.attempt_id, coalesce(r.n, 0) AS raw_rows, p.process_attempt_id, p.status AS process_status FROM att a LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) r ON r.l_orderkey = a.attempt_no LEFT JOIN latest p ON p.attempt_id = a.attempt_id", "att", "latest")
def left_join_chain(spark, d):
    return _health(spark, d).select("attempt_id", "raw_rows", "process_attempt_id", "process_status")


@query(f"SELECT c.case_id, coalesce(a.n, 0) AS event_count FROM cases c LEFT JOIN (SELECT case_id, count(*) AS n FROM ({_MATCHED} AND e.magnitude > 5) GROUP BY 1) a USING (case_id)", "cases", "bridge", "cur")
def left_join_keep_zero(spark, d):
    counts = _matched(spark, d).where("magnitude > 5").groupBy("case_id").agg(F.count("*").alias("event_count"))
    return _cases(spark).select("case_id").join(counts, "case_id", "left").fillna(0, ["event_count"])


@query("SELECT o.o_orderkey, count(l.l_linenumber) AS late_lines FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R' GROUP BY 1")
def left_join_filtered_right(spark, d):
    right = _table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return _table(spark, d, "orders").join(right, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(F.count("l_linenumber").alias("late_lines"))


@query("SELECT site_key, count(*) AS rows_, count_if(epicentral_distance_km IS NULL) AS unlocated, count_if(within_radius) AS inside FROM bridge GROUP BY 1", "bridge")
def cross_join_sites(spark, d):
    return _bridge(spark, d).groupBy("site_key").agg(F.count("*").alias("rows_"), F.count_if(F.col("epicentral_distance_km").isNull()).alias("unlocated"), F.count_if("within_radius").alias("inside"))


# ---- aggregates [D*]
@query("SELECT attempt_id, count(*) AS staging_rows, count_if(reject_reason IS NOT NULL) AS reject_rows FROM obs GROUP BY 1", "obs")
def count_if_grouped(spark, d):
    return _obs(spark, d).groupBy("attempt_id").agg(F.count("*").alias("staging_rows"), F.count_if(F.col("reject_reason").isNotNull()).alias("reject_rows"))


@query("SELECT health_status, sum(coalesce(processed_rows, 0))::BIGINT AS processed_rows, sum(loaded_rows)::BIGINT AS loaded_rows FROM health GROUP BY 1", "health")
def sum_coalesce(spark, d):
    return _health(spark, d).groupBy("health_status").agg(F.sum(F.coalesce("processed_rows", F.lit(0))).alias("processed_rows"), F.sum("loaded_rows").alias("loaded_rows"))


@query("SELECT site_key, min(magnitude) AS least, max(magnitude) AS most, min(source_updated_at) AS first_update, max(source_updated_at) AS last_update FROM cur JOIN bridge USING (canonical_event_id, source_updated_at, payload_hash) WHERE within_radius GROUP BY 1", "cur", "bridge")
def min_max(spark, d):
    inside = _near(spark, d)
    return inside.groupBy("site_key").agg(F.min("magnitude").alias("least"), F.max("magnitude").alias("most"), F.min("source_updated_at").alias("first_update"), F.max("source_updated_at").alias("last_update"))


@query("SELECT source_status, count(DISTINCT canonical_event_id) AS events FROM obs GROUP BY 1", "obs")
def count_distinct(spark, d):
    return _obs(spark, d).groupBy("source_status").agg(F.count_distinct("canonical_event_id").alias("events"))


@query("SELECT *, sample_attempts >= 30 AND p95_seconds <= 86400 AS target_met FROM (SELECT count(*) AS sample_attempts, min(fetch_to_curated_seconds) AS min_seconds, round(quantile_cont(fetch_to_curated_seconds, 0.5), 1) AS p50_seconds, round(quantile_cont(fetch_to_curated_seconds, 0.95), 1) AS p95_seconds, max(fetch_to_curated_seconds) AS max_seconds FROM health WHERE batch_kind = 'origin' AND fetch_to_curated_seconds IS NOT NULL)", "health")
def percentile_latency(spark, d):
    s = "fetch_to_curated_seconds"
    some = _health(spark, d).where((F.col("batch_kind") == "origin") & F.col(s).isNotNull())
    stored = Scratch(spark, "latency").cut(some.select(s), "seconds")  # read once for each pass
    out = selection.percentiles(stored, s, [0.5, 0.95], names=["p50", "p95"])
    met = (F.col("sample_attempts") >= 30) & (F.col("p95_seconds") <= 86_400)
    return out.select(F.col("n").alias("sample_attempts"), F.col("least").alias("min_seconds"), F.round("p50", 1).alias("p50_seconds"), F.round("p95", 1).alias("p95_seconds"), F.col("most").alias("max_seconds")).withColumn("target_met", met)


@query("SELECT l_returnflag, count(l_extendedprice) AS n, min(l_extendedprice) AS least, max(l_extendedprice) AS most, round(quantile_cont(l_extendedprice, 0.05), 6) AS p5, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.999), 6) AS p99_9 FROM lineitem GROUP BY 1")
def price_percentiles(spark, d):
    """Exact percentiles of groups by counting passes; no task holds a group's values [D6]."""
    out = selection.percentiles(_table(spark, d, "lineitem"), "l_extendedprice", [0.05, 0.5, 0.999], ["l_returnflag"])
    return out.select("l_returnflag", "n", "least", "most", *(F.round(c, 6).alias(c) for c in ("p5", "p50", "p99_9")))


@query(f"SELECT {KEY}, count(*) AS duplicate_rows FROM obs GROUP BY {KEY} HAVING count(*) > 1", "obs")
def duplicate_keys(spark, d):
    return _obs(spark, d).groupBy(*REVISION_KEY).agg(F.count("*").alias("duplicate_rows")).where("duplicate_rows > 1")


@query("SELECT DISTINCT cast(t AS DATE) AS date_key, year(t)::INTEGER AS calendar_year, month(t)::INTEGER AS calendar_month FROM (SELECT origin_time AS t FROM obs UNION ALL SELECT source_updated_at FROM obs)", "obs")
def distinct_values(spark, d):
    t = _obs(spark, d).select(F.explode(F.array("origin_time", "source_updated_at")).alias("t")).select(F.to_date("t").alias("date_key")).distinct()
    return t.select("date_key", F.year("date_key").alias("calendar_year"), F.month("date_key").alias("calendar_month"))


_RANKED = f"SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY epicentral_distance_km, canonical_event_id) AS nearest_rank FROM ({_MATCHED})"


@query(f"SELECT case_id, count(*) AS event_count, max(CASE WHEN nearest_rank = 1 THEN canonical_event_id END) AS nearest_event_id, max(CASE WHEN nearest_rank = 1 THEN magnitude END) AS nearest_magnitude FROM ({_RANKED}) GROUP BY 1", "cases", "bridge", "cur")
def rank1_pivot(spark, d):
    """The nearest event's fields by min_by: one aggregate, no window."""
    near = F.min_by(F.struct("canonical_event_id", "magnitude"), F.struct("epicentral_distance_km", "canonical_event_id"))
    return _matched(spark, d).groupBy("case_id").agg(F.count("*").alias("event_count"), near.alias("n")).select("case_id", "event_count", F.col("n.canonical_event_id").alias("nearest_event_id"), F.col("n.magnitude").alias("nearest_magnitude"))


@query("SELECT site_key, year(origin_time)::INTEGER AS calendar_year, count(DISTINCT canonical_event_id) AS events FROM cur JOIN bridge USING (canonical_event_id, source_updated_at, payload_hash) WHERE within_radius GROUP BY 1, 2", "cur", "bridge")
def year_site_counts(spark, d):
    inside = _near(spark, d)
    return inside.groupBy("site_key", F.year("origin_time").alias("calendar_year")).agg(F.count_distinct("canonical_event_id").alias("events"))


@query("SELECT reject_reason, count(*) AS n FROM obs WHERE reject_reason IS NOT NULL GROUP BY 1 ORDER BY n DESC, reject_reason", "obs")
def reject_histogram(spark, d):
    return _obs(spark, d).where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reject_reason")


# ---- ranks, top-k [E*, F*]
@query(f"SELECT {KEY}, source_status, magnitude FROM cur", "cur")
def current_rank(spark, d):
    return _current(spark, d).select(*REVISION_KEY, "source_status", "magnitude")


@query("SELECT attempt_id, process_attempt_id, status FROM latest", "latest")
def latest_process(spark, d):
    return views.latest_process(adapter.processes(spark, d), "finished_second").select("attempt_id", "process_attempt_id", "status")


@query(f"SELECT case_id, canonical_event_id, round(epicentral_distance_km, 3) AS km FROM (SELECT *, row_number() OVER (PARTITION BY case_id, canonical_event_id ORDER BY source_updated_at DESC, payload_hash DESC, epicentral_distance_km) AS rk FROM ({_MATCHED})) WHERE rk = 1", "cases", "bridge", "cur")
def dedup_case(spark, d):
    return _matched(spark, d).select("case_id", "canonical_event_id", F.round("epicentral_distance_km", 3).alias("km"))


@query(f"SELECT case_id, canonical_event_id, round(epicentral_distance_km, 3) AS km FROM ({_RANKED}) WHERE nearest_rank = 1", "cases", "bridge", "cur")
def nearest_per_case(spark, d):
    w = Window.partitionBy("case_id").orderBy("epicentral_distance_km", "canonical_event_id")
    return _matched(spark, d).withColumn("rk", F.row_number().over(w)).where("rk = 1").select("case_id", "canonical_event_id", F.round("epicentral_distance_km", 3).alias("km"))


@query("SELECT attempt_id, fetched_at FROM health WHERE health_status = 'PENDING_PROCESS' ORDER BY fetched_at, attempt_id LIMIT 20", "health")
def pending_limit(spark, d):
    """The work queue, bounded as the feature says: the oldest 20."""
    return _health(spark, d).where("health_status = 'PENDING_PROCESS'").select("attempt_id", "fetched_at").orderBy("fetched_at", "attempt_id").limit(20)


@query("SELECT canonical_event_id, site_key, round(epicentral_distance_km, 3) AS km FROM bridge WHERE within_radius ORDER BY epicentral_distance_km, canonical_event_id, source_updated_at, payload_hash, site_key LIMIT 1", "bridge")
def nearest_limit1(spark, d):
    ordered = _bridge(spark, d).where("within_radius").orderBy("epicentral_distance_km", "canonical_event_id", "source_updated_at", "payload_hash", "site_key").limit(1)
    return ordered.select("canonical_event_id", "site_key", F.round("epicentral_distance_km", 3).alias("km"))


# ---- scalars [H*]
@query("SELECT event_id, try_cast(event_type AS DOUBLE) AS no_number, try_cast(event_id || '.5' AS DOUBLE) AS number, try_cast(event_id || '.1234' AS DECIMAL(38,3))::DOUBLE AS rounded, try_cast(event_type AS TIMESTAMP) AS no_time, cast(ts AS DATE) AS day, year(ts)::INTEGER AS year_ FROM events")
def scalar_try_casts(spark, d):
    text = F.col("event_id").cast("string")
    return _table(spark, d, "events").select("event_id", F.col("event_type").try_cast("double").alias("no_number"), F.concat(text, F.lit(".5")).try_cast("double").alias("number"), F.concat(text, F.lit(".1234")).try_cast("decimal(38,3)").cast("double").alias("rounded"),
        F.try_to_timestamp("event_type").alias("no_time"), F.to_date("ts").alias("day"), F.year("ts").alias("year_"))


@query(f"SELECT sum(datediff('minute', ts, TIMESTAMP '{AS_OF}'))::BIGINT AS minutes, sum(datediff('second', ts, TIMESTAMP '{AS_OF}'))::BIGINT AS seconds FROM events")
def datediff_boundary(spark, d):
    ts, end = F.col("ts").cast("timestamp"), F.lit(AS_OF).cast("timestamp")
    return _table(spark, d, "events").agg(F.sum(views.boundary_diff("minute", ts, end)).alias("minutes"), F.sum(views.boundary_diff("second", ts, end)).alias("seconds"))


@query("SELECT event_id, array_to_string(list_filter(string_split(',u' || event_id || ',,u' || event_id % 7 || ',', ','), lambda x: x <> ''), ';') AS ids FROM events")
def split_ids(spark, d):
    text = F.concat(F.lit(",u"), "event_id", F.lit(",,u"), F.col("event_id") % 7, F.lit(","))
    return _table(spark, d, "events").select("event_id", F.array_join(F.filter(F.split(text, ","), lambda x: x != ""), ";").alias("ids"))


@query("SELECT event_id, payload_hash FROM obs", "obs")
def sha256_key(spark, d):
    return _obs(spark, d).select("event_id", "payload_hash")


@query("SELECT canonical_event_id, source_updated_at, payload_hash, site_key, round(epicentral_distance_km, 3) AS km, within_radius FROM bridge", "bridge")
def haversine(spark, d):
    return _bridge(spark, d).select(*REVISION_KEY, "site_key", F.round("epicentral_distance_km", 3).alias("km"), "within_radius")


# ---- windows [I*]
_MONTHS = "SELECT s.n * 60 + k + 1 AS window_no, site_key, TIMESTAMP '2026-09-29' - to_months((60 - k)::INTEGER) AS window_start, TIMESTAMP '2026-09-29' - to_months((59 - k)::INTEGER) AS window_end FROM (VALUES (0, 'seattle'), (1, 'san-francisco'), (2, 'anchorage')) s(n, site_key), range(60) r(k)"


@query(f"SELECT window_no::BIGINT AS window_no, site_key, window_start, window_end FROM ({_MONTHS})")
def month_windows(spark, d):
    w = windows.history_windows(spark, CUTOFF)
    return w.withColumn("window_no", F.col("window_no").cast("long"))


@query(f"SELECT window_no::BIGINT AS window_no, k AS slice_no, s AS slice_start, least(s + INTERVAL 7 DAY, window_end) AS slice_end FROM (SELECT *, unnest(range(window_start, window_end, INTERVAL 7 DAY)) AS s, unnest(range(len(range(window_start, window_end, INTERVAL 7 DAY)))) AS k FROM ({_MONTHS}))")
def day_hour_slices(spark, d):
    w = windows.slices(windows.history_windows(spark, CUTOFF), "day", 7)
    return w.select(F.col("window_no").cast("long").alias("window_no"), F.col("slice_no").cast("long").alias("slice_no"), "slice_start", "slice_end")


@query("SELECT event_id, source_updated_at FROM obs WHERE source_updated_at > (SELECT date_trunc('day', max(fetched_at)) FROM obs) - INTERVAL 259200 SECOND", "obs")
def watermark_overlap(spark, d):
    mark = _obs(spark, d).agg(F.date_trunc("day", F.max("fetched_at")).alias("committed_watermark"))
    return windows.overlap_filter(_obs(spark, d), mark, 259_200).select("event_id", "source_updated_at")


@query("SELECT attempt_id, count(*) AS n_windows, count_if(s > b) AS gaps, count_if(s < b) AS overlap_count FROM (SELECT attempt_id, s, lag(e) OVER (PARTITION BY attempt_id ORDER BY s, e) AS b FROM (SELECT attempt_id, source_updated_at AS s, source_updated_at + INTERVAL 1 DAY AS e FROM obs)) GROUP BY 1", "obs")
def window_contiguity(spark, d):
    w = _obs(spark, d).select("attempt_id", F.col("source_updated_at").alias("s"), (F.col("source_updated_at") + F.make_dt_interval(F.lit(1))).alias("e"))
    return windows.contiguity(w, "attempt_id", "s", "e").withColumnsRenamed({"windows": "n_windows", "overlaps": "overlap_count"})


# ---- domain operators [K*]
_ALIASES = "SELECT 'u' || event_id AS a, CASE WHEN event_id % 5 = 0 THEN 'u' || (event_id * 7 % 10000) END AS b FROM events"


@query(f"WITH RECURSIVE e AS ({_ALIASES}), both_ AS (SELECT a, b FROM e WHERE b IS NOT NULL UNION SELECT b, a FROM e WHERE b IS NOT NULL), reach(v, w) AS (SELECT a, a FROM both_ UNION SELECT r.v, x.b FROM reach r JOIN both_ x ON x.a = r.w) SELECT v AS source_event_id, min(w) AS canonical_id FROM (SELECT v, w FROM reach UNION ALL SELECT a, a FROM e) GROUP BY 1")
def alias_components(spark, d):
    """Canonical ids of all events; one in five names an alias, the others none."""
    n = F.col("event_id")
    ids = F.when(n % 5 == 0, F.array(F.concat(F.lit("u"), n * 7 % 10000))).otherwise(F.array().cast("array<string>"))
    return aliases.canonical_ids(_table(spark, d, "events").select(F.concat(F.lit("u"), n).alias("source_event_id"), ids.alias("associated_ids")))


@query(f"SELECT {KEY}, fetched_at, stage_file_name, stage_file_row_number FROM facts", "facts")
def revision_dedup(spark, d):
    return _facts(spark, d).select(*REVISION_KEY, "fetched_at", "stage_file_name", "stage_file_row_number")


_HALF = "event_id % 2 = 0"


def _half_facts(spark: SparkSession, d: str, keep: str) -> DataFrame:
    return revisions.dedup(_obs(spark, d).where(keep)).select(*REVISION_KEY, "fetched_at", "stage_file_name", "stage_file_row_number", "magnitude")


def _half(keep: str) -> str:
    return f"SELECT {KEY}, fetched_at, stage_file_name, stage_file_row_number, magnitude FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY fetched_at DESC, stage_file_name DESC, stage_file_row_number DESC) AS rn FROM obs WHERE {keep}) WHERE rn = 1"


@query(f"SELECT stage_file_name, stage_file_row_number, event_id FROM obs WHERE NOT ({_HALF})", "obs")
def merge_insert_only(spark, d):
    rows = _obs(spark, d).select("stage_file_name", "stage_file_row_number", "event_id")
    return merge.insert_only(rows.where(_HALF), rows, ["stage_file_name", "stage_file_row_number"])


@query(f"SELECT {KEY}, CASE WHEN t.fetched_at IS NULL OR s.fetched_at > t.fetched_at THEN s.fetched_at ELSE t.fetched_at END AS fetched_at, CASE WHEN t.fetched_at IS NULL THEN s.magnitude ELSE t.magnitude END AS magnitude, CASE WHEN t.fetched_at IS NULL THEN 'inserted' WHEN s.fetched_at > t.fetched_at THEN 'updated' ELSE 'kept' END AS merge_action FROM ({_half(_HALF)}) t FULL JOIN ({_half('NOT (' + _HALF + ')')}) s USING ({KEY})", "obs")
def merge_later_fetch(spark, d):
    """A later fetch refreshes lineage; measures stay."""
    out = merge.upsert(_half_facts(spark, d, _HALF), _half_facts(spark, d, f"NOT ({_HALF})"), REVISION_KEY, ["fetched_at", "stage_file_name", "stage_file_row_number"], F.col("s.fetched_at") > F.col("t.fetched_at"))
    return out.select(*REVISION_KEY, "fetched_at", "magnitude", "merge_action")


@query(f"SELECT {KEY}, CASE WHEN s.fetched_at IS NULL THEN t.fetched_at ELSE s.fetched_at END AS fetched_at, CASE WHEN s.fetched_at IS NULL THEN t.magnitude ELSE s.magnitude END AS magnitude, CASE WHEN t.fetched_at IS NULL THEN 'inserted' WHEN s.fetched_at IS NULL THEN 'kept' ELSE 'updated' END AS merge_action FROM ({_half(_HALF)}) t FULL JOIN ({_half('NOT (' + _HALF + ')')}) s USING ({KEY})", "obs")
def merge_upsert(spark, d):
    out = merge.upsert(_half_facts(spark, d, _HALF), _half_facts(spark, d, f"NOT ({_HALF})"), REVISION_KEY, ["fetched_at", "magnitude", "stage_file_name", "stage_file_row_number"])
    return out.select(*REVISION_KEY, "fetched_at", "magnitude", "merge_action")


@query(f"SELECT new_id AS canonical_event_id, source_updated_at, event_type AS payload_hash, fetched_at, canonical_event_id AS source_event_id FROM (SELECT *, row_number() OVER (PARTITION BY new_id, source_updated_at, event_type ORDER BY fetched_at DESC, stage_file_name DESC, stage_file_row_number DESC, canonical_event_id DESC) AS rk FROM (SELECT *, 'u' || (cast(substr(canonical_event_id, 2) AS BIGINT) % 50) AS new_id FROM facts) f) WHERE rk = 1", "facts")
def rekey_collision(spark, d):
    facts = _facts(spark, d).withColumns({"source_event_id": F.col("canonical_event_id"), "payload_hash": F.col("event_type")})
    mapping = facts.select("source_event_id").distinct().select("source_event_id", F.concat(F.lit("u"), F.substring("source_event_id", 2, 20).cast("long") % 50).alias("canonical_id"))
    kept, _ = revisions.rekey(facts, geo.bridge(facts), mapping)
    return kept.select("canonical_event_id", "source_updated_at", "payload_hash", "fetched_at", "source_event_id")


@query("SELECT o.event_id, CASE WHEN o.reject_reason = 'source_stub_record' THEN 'relabelled-' || s.event_type ELSE o.reject_reason END AS reject_reason FROM obs o JOIN events s USING (event_id)", "obs")
def update_from(spark, d):
    rows, raw = _obs(spark, d).select("event_id", "reject_reason"), _table(spark, d, "events").select("event_id", F.concat(F.lit("relabelled-"), "event_type").alias("label"))
    return merge.update_from(rows, raw, ["event_id"], {"reject_reason": "label"}, F.col("t.reject_reason") == "source_stub_record")


@query("SELECT attempt_id, raw_rows, staging_rows, staging_reject_rows, receipt_gap_count, health_status FROM health", "health")
def batch_health(spark, d):
    return _health(spark, d).select("attempt_id", "raw_rows", "staging_rows", "staging_reject_rows", "receipt_gap_count", "health_status")


@query("SELECT 'o' || l_orderkey AS attempt_id, 'w' || l_linenumber AS window_id, CASE WHEN l_linenumber % 5 = 0 THEN 'unresolved' ELSE 'reconciled' END AS window_status, l_linenumber::BIGINT AS count_before, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linenumber::BIGINT END AS returned_rows FROM lineitem")
def window_audit(spark, d):
    n = F.col("l_linenumber")
    item = F.struct(F.concat(F.lit("w"), n).alias("window_id"), F.when(n % 5 == 0, "unresolved").otherwise("reconciled").alias("status"), n.alias("count_before"), F.when(n % 3 != 0, n).alias("returned_rows"))
    receipts = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.parse_json(F.to_json(F.collect_list(item))).alias("window_audit")).select(F.concat(F.lit("o"), "l_orderkey").alias("attempt_id"), F.lit("origin").alias("batch_kind"), "window_audit")
    return views.window_audit(receipts).select("attempt_id", "window_id", "window_status", "count_before", "returned_rows")


@query("SELECT health_status, count(*) AS attempts, sum(loaded_rows)::BIGINT AS receipt_loaded_rows, sum(raw_rows)::BIGINT AS observed_raw_rows, sum(staging_rows)::BIGINT AS observed_staging_rows, sum(coalesce(processed_rows, 0))::BIGINT AS processed_rows, sum(coalesce(rejected_rows, 0))::BIGINT AS rejected_rows FROM health GROUP BY 1", "health")
def reconciliation(spark, d):
    return views.reconciliation(_health(spark, d))


@query(f"SELECT max(fetched_at) AS last_successful_fetch, datediff('second', max(fetched_at), TIMESTAMP '{AS_OF}') AS age_seconds, count(*) AS reconciled FROM health WHERE health_status = 'RECONCILED'", "health")
def freshness(spark, d):
    end = F.lit(AS_OF).cast("timestamp")
    return _health(spark, d).where("health_status = 'RECONCILED'").agg(F.max("fetched_at").alias("last_successful_fetch"), F.count("*").alias("reconciled")).withColumn("age_seconds", views.boundary_diff("second", F.col("last_successful_fetch"), end))


@query(f"""SELECT c.case_id, c.site_key, s.radius_km, 1::BIGINT AS distinct_radii, coalesce(a.event_count, 0) AS event_count, a.nearest_event_id, a.nearest_distance_km, a.nearest_magnitude, a.nearest_source_status, a.nearest_record_age_hours
  FROM cases c LEFT JOIN sites s ON s.site_key = c.site_key LEFT JOIN (SELECT case_id, count(*) AS event_count, max(CASE WHEN nearest_rank = 1 THEN canonical_event_id END) AS nearest_event_id, max(CASE WHEN nearest_rank = 1 THEN round(epicentral_distance_km, 1) END) AS nearest_distance_km,
    max(CASE WHEN nearest_rank = 1 THEN magnitude END) AS nearest_magnitude, max(CASE WHEN nearest_rank = 1 THEN source_status END) AS nearest_source_status, max(CASE WHEN nearest_rank = 1 THEN round(datediff('minute', source_updated_at, TIMESTAMP '{AS_OF}') / 60e0, 1) END) AS nearest_record_age_hours
    FROM ({_RANKED}) GROUP BY 1) a USING (case_id)""", "cases", "sites", "bridge", "cur")  # fmt: skip
def site_window_aggregates(spark, d):
    """Flagship [K20]: per case the events, and the nearest one's fields; cases without events stay."""
    near = F.min_by(F.struct("canonical_event_id", "epicentral_distance_km", "magnitude", "source_status", "source_updated_at"), F.struct("epicentral_distance_km", "canonical_event_id"))
    found = _matched(spark, d).groupBy("case_id").agg(F.count("*").alias("event_count"), near.alias("n"))
    radii = geo.sites(spark).groupBy("site_key").agg(F.max("radius_km").alias("radius_km"), F.count_distinct("radius_km").alias("distinct_radii"))
    age = F.round(views.boundary_diff("minute", F.col("n.source_updated_at"), F.lit(AS_OF).cast("timestamp")) / 60.0, 1)
    return _cases(spark).join(radii, "site_key", "left").join(found, "case_id", "left").select(
        "case_id", "site_key", "radius_km", "distinct_radii", F.coalesce("event_count", F.lit(0)).alias("event_count"), F.col("n.canonical_event_id").alias("nearest_event_id"), F.round("n.epicentral_distance_km", 1).alias("nearest_distance_km"),
        F.col("n.magnitude").alias("nearest_magnitude"), F.col("n.source_status").alias("nearest_source_status"), age.alias("nearest_record_age_hours"))


@query("SELECT attempt_id, CASE WHEN load_status IS NULL AND raw_rows = 0 THEN 'ready' WHEN load_status = 'complete' AND loaded_rows = raw_rows AND raw_rows = expected_rows THEN 'loaded' ELSE 'investigate' END AS load_state FROM (SELECT a.attempt_id, a.raw_rows_written AS expected_rows, CASE WHEN a.attempt_no % 7 <> 0 THEN a.load_status END AS load_status, CASE WHEN a.attempt_no % 7 <> 0 THEN a.loaded_rows END AS loaded_rows, CASE WHEN a.attempt_no % 14 = 0 THEN 0 ELSE a.loaded_rows END AS raw_rows FROM att a)", "att")
def load_state(spark, d):
    a = _attempts(spark, d, Scratch(spark, "load-state"))
    return views.load_state(a.select("attempt_id", F.col("raw_rows_written").alias("expected_rows")), a.where("attempt_no % 7 <> 0"), a.where("attempt_no % 14 <> 0").select("attempt_id", F.col("loaded_rows").alias("raw_rows")))


@query(f"""SELECT (SELECT count(*) FROM health WHERE health_status NOT IN ('RECONCILED', 'PENDING_PROCESS')) AS batch_anomalies, (SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY {KEY} HAVING count(*) > 1)) AS duplicate_facts,
  (SELECT sum(staging_reject_rows)::BIGINT FROM health) AS health_rejects, CASE WHEN (SELECT count(*) FROM health WHERE health_status <> 'RECONCILED') = 0 THEN 'pass' ELSE 'review' END AS verdict""", "health", "facts")  # fmt: skip
def postrun_verdict(spark, d):
    h = _health(spark, d).agg(F.count_if(~F.col("health_status").isin("RECONCILED", "PENDING_PROCESS")).alias("batch_anomalies"), F.sum("staging_reject_rows").alias("health_rejects"), F.count_if(F.col("health_status") != "RECONCILED").alias("other"))
    dup = _facts(spark, d).groupBy(*REVISION_KEY).count().where("count > 1").agg(F.count("*").alias("duplicate_facts"))
    return h.crossJoin(dup).select("batch_anomalies", "duplicate_facts", "health_rejects", F.when((F.col("other") == 0) & (F.col("duplicate_facts") == 0), "pass").otherwise("review").alias("verdict"))


@query("SELECT site_key, year(origin_time)::INTEGER AS calendar_year, cast(floor(least(magnitude, 100) / 10) AS BIGINT) AS band, count(*) AS events FROM cur JOIN bridge USING (canonical_event_id, source_updated_at, payload_hash) WHERE within_radius AND magnitude IS NOT NULL GROUP BY 1, 2, 3", "cur", "bridge")
def magnitude_bands(spark, d):
    inside = _near(spark, d).where("magnitude IS NOT NULL")
    return inside.groupBy("site_key", F.year("origin_time").alias("calendar_year"), F.floor(F.least("magnitude", F.lit(100.0)) / 10).alias("band")).agg(F.count("*").alias("events"))


@query("SELECT site_key, event_type, count(*) AS revisions, round(avg(datediff('second', source_updated_at, fetched_at)), 3) AS delay_seconds FROM facts JOIN bridge USING (canonical_event_id, source_updated_at, payload_hash) WHERE within_radius GROUP BY 1, 2", "facts", "bridge")
def revision_delay(spark, d):
    inside = geo.measured(_facts(spark, d)).where("within_radius")
    return inside.groupBy("site_key", "event_type").agg(F.count("*").alias("revisions"), F.round(F.avg(views.boundary_diff("second", F.col("source_updated_at"), F.col("fetched_at"))), 3).alias("delay_seconds"))


@query("SELECT canonical_event_id, origin_time, magnitude FROM cur WHERE origin_time >= TIMESTAMP '2024-01-01' AND origin_time < TIMESTAMP '2024-02-01'", "cur")
def current_in_window(spark, d):
    return _current(spark, d).where("origin_time >= timestamp'2024-01-01' AND origin_time < timestamp'2024-02-01'").select("canonical_event_id", "origin_time", "magnitude")


from revisio.plans import contract_queries, scale_queries  # noqa: E402, F401  they register further queries
