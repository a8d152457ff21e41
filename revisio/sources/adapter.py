"""The driver's tables as warehouse tables: integer arithmetic only, the same text in both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBSERVATIONS = """
SELECT event_id, 'a' || (event_id % 12) AS attempt_id, 'w' || (event_id % 4) AS window_id,
  'a' || (event_id % 12) || '/events.jsonl' AS stage_file_name, cast(floor(event_id / 12) AS bigint) + 1 AS stage_file_row_number,
  'u' || (user_id * 20 + event_id % 20) AS canonical_event_id, date_trunc('day', {ts}) AS source_updated_at,
  date_trunc('month', {ts}) AS origin_time, {ts} AS fetched_at,
  {sha}((user_id * 20 + event_id % 20) || event_type{bits}) AS payload_hash,
  CASE event_type WHEN 'error' THEN 'deleted' WHEN 'purchase' THEN 'reviewed' ELSE 'automatic' END AS source_status,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS magnitude,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN NULL ELSE
    (CASE event_id % 3 WHEN 0 THEN -122.3321e0 WHEN 1 THEN -122.4194e0 ELSE -149.9003e0 END) + (event_id % 97 - 48) / 10e0 END AS longitude,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN NULL ELSE
    (CASE event_id % 3 WHEN 0 THEN 47.6062e0 WHEN 1 THEN 37.7749e0 ELSE 61.2181e0 END) + (event_id % 41 - 20) / 10e0 END AS latitude,
  CASE WHEN event_id % 50 = 0 THEN 'source_stub_record' WHEN event_id % 53 = 0 THEN 'invalid_geometry' END AS reject_reason,
  event_type, props
FROM {events}
"""

ATTEMPTS = """
SELECT o.o_orderkey AS attempt_no, 'o' || o.o_orderkey AS attempt_id, CASE WHEN o.o_orderkey % 10 = 0 THEN 'update_sweep' ELSE 'origin' END AS batch_kind,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'seattle' WHEN 1 THEN 'san-francisco' ELSE 'anchorage' END AS site_key,
  {o_ts} AS fetched_at, CASE WHEN o.o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS gap_count,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'failed' ELSE 'complete' END AS load_status,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE coalesce(l.n, 0) END AS source_rows_returned,
  coalesce(l.n, 0) + (CASE WHEN o.o_orderkey % 19 = 0 THEN 1 ELSE 0 END) AS raw_rows_written,
  coalesce(l.n, 0) AS loaded_rows, coalesce(l.rejects, 0) AS staged_rejects
FROM {orders} o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, count_if(l_linenumber = 7) AS rejects FROM {lineitem} GROUP BY l_orderkey
) l ON l.l_orderkey = o.o_orderkey
"""

PROCESSES = """
SELECT attempt_id, attempt_id || '-p' || k AS process_attempt_id, CASE WHEN attempt_no % 29 = 0 AND k = 2 THEN 'failed' ELSE 'complete' END AS status,
  CASE WHEN attempt_no % 7 = 0 THEN 10 ELSE 10 * k END AS finished_second, loaded_rows,
  loaded_rows - (CASE WHEN attempt_no % 31 = 0 THEN 1 ELSE 0 END) AS processed_rows, staged_rejects AS rejected_rows
FROM {attempts} CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k) ks
WHERE attempt_no % 23 <> 0 AND (k = 1 OR attempt_no % 2 = 1)
"""


def text(template: str, dialect: str, **tables: str) -> str:
    """A template's SQL: 'spark' with named frames, 'duck' with table names."""
    spark = dialect == "spark"
    return template.format(
        ts="cast(ts AS timestamp)" if spark else "ts", o_ts="cast(o.o_orderdate AS timestamp)" if spark else "o.o_orderdate",
        sha="sha2" if spark else "sha256", bits=", 256" if spark else "", **tables,
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(text(OBSERVATIONS, "spark", events="{events}"), events=table(spark, sf_dir, "events"))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).where("reject_reason IS NULL")


def attempts(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """lines: lineitem, if its rows are stored already."""
    return spark.sql(text(ATTEMPTS, "spark", orders="{orders}", lineitem="{lineitem}"), orders=table(spark, sf_dir, "orders"), lineitem=table(spark, sf_dir, "lineitem") if lines is None else lines)


def processes(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """of: the attempts, if they are stored already."""
    return spark.sql(text(PROCESSES, "spark", attempts="{attempts}"), attempts=attempts(spark, sf_dir) if of is None else of)
