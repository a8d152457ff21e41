"""Fixed values and table layouts of the warehouse."""

from __future__ import annotations

#: Site key, name, latitude, longitude.
SITES = (
    ("seattle", "Seattle", 47.6062, -122.3321),
    ("san-francisco", "San Francisco", 37.7749, -122.4194),
    ("anchorage", "Anchorage", 61.2181, -149.9003),
)
RADIUS_KM = 250.0
EARTH_RADIUS_KM = 6371.0088
STAGING_PARSER_VERSION = "2"
RAW_PARSER_VERSION = "1"
HISTORY_MONTHS = 60
LATENCY_TARGET_SECONDS, LATENCY_LEAST_SAMPLE = 86_400, 30

REVISION_KEY = ("canonical_event_id", "source_updated_at", "payload_hash")
FILE_ROW = ("stage_file_name", "stage_file_row_number")

#: Tables that are merged by key when they are read: the latest segment's row of a key holds.
MERGED = {"fact_event_revision": REVISION_KEY, "bridge_event_site": (*REVISION_KEY, "site_key"), "alias_label": ("source_event_id",), "fact_batch_run": ("attempt_id",)}

#: Tables whose segments hold a folder for each attempt, so that an attempt reads its own rows alone.
BY_ATTEMPT = ("raw_event_records", "stg_event_revision")

TABLES = {
    "batch_attempt": """attempt_id string, logical_batch_id string, batch_kind string, site_key string, requested_starttime timestamp,
        requested_endtime timestamp, query_parameters variant, window_audit variant, coverage_gaps variant, fetched_at timestamp,
        extract_status string, load_status string, source_rows_returned bigint, raw_rows_written bigint, loaded_rows bigint,
        staged_files variant, copy_results variant, error_type string, error_message string, manifest variant, recorded_at timestamp""",
    "raw_event_records": """logical_batch_id string, attempt_id string, window_id string, payload variant, fetched_at timestamp,
        payload_hash string, parser_version string, stage_file_name string, stage_file_row_number bigint, loaded_at timestamp""",
    "stg_event_revision": """stage_file_name string, stage_file_row_number bigint, attempt_id string, window_id string, fetched_at timestamp,
        payload_hash string, raw_parser_version string, staging_parser_version string, source_event_id string, origin_time timestamp,
        source_updated_at timestamp, source_status string, associated_ids array<string>, magnitude double, magnitude_type string,
        place string, longitude double, latitude double, depth_km double, reject_reason string, projected_at timestamp""",
    "fact_event_revision": """canonical_event_id string, source_updated_at timestamp, payload_hash string, source_event_id string,
        associated_ids array<string>, origin_time timestamp, fetched_at timestamp, curated_at timestamp, source_status string,
        magnitude double, magnitude_type string, place string, longitude double, latitude double, depth_km double,
        staging_parser_version string, stage_file_name string, stage_file_row_number bigint""",
    "bridge_event_site": """canonical_event_id string, source_updated_at timestamp, payload_hash string, site_key string,
        epicentral_distance_km double, within_radius boolean""",
    "alias_label": "source_event_id string, canonical_id string",
    "dim_date": "date_key date, calendar_year int, calendar_month int",
    "dim_site": "site_key string, site_name string, latitude double, longitude double, radius_km double",
    "dim_magnitude_type": "magnitude_type string",
    "dim_event_status": "source_status string",
    "fact_batch_run": """attempt_id string, logical_batch_id string, batch_kind string, site_key string, requested_starttime timestamp,
        requested_endtime timestamp, fetched_at timestamp, raw_recorded_at timestamp, curated_at timestamp, source_rows_returned bigint,
        raw_rows_written bigint, loaded_rows bigint, processed_rows bigint, rejected_rows bigint, fetch_to_curated_seconds decimal(38,3),
        extract_status string, load_status string, process_status string, last_process_attempt_id string, coverage_gaps variant,
        reconciliation_ok boolean, updated_at timestamp""",
    "batch_process_attempt": """process_attempt_id string, attempt_id string, started_at timestamp, finished_at timestamp, status string,
        staging_parser_version string, loaded_rows bigint, processed_rows bigint, rejected_rows bigint, revision_rows_merged bigint,
        error_type string, error_message string, recorded_at timestamp""",
    "update_watermark": """sweep_name string, committed_watermark timestamp, previous_watermark timestamp, attempt_id string,
        catalog_lower_bound timestamp, origin_time_cutoff timestamp, committed_at timestamp""",
}
