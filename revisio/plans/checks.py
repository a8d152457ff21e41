"""Reviewed statements: pinned by their digest, compiled without being run, bound to parameters [B15, K26-K28]."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Reviewed statements over views (see `views.create`), and the SHA-256 of each list's text.
UNIQUENESS = """
SELECT canonical_event_id, source_updated_at, payload_hash, count(*) AS n FROM fact_event_revision GROUP BY ALL HAVING count(*) > 1;
SELECT canonical_event_id, source_updated_at, payload_hash, site_key, count(*) AS n FROM bridge_event_site GROUP BY ALL HAVING count(*) > 1;
"""
UNIQUENESS_SHA256 = "b4ac8bdea5027599b459275951d6f6c7a5f41705d2367986b46069ffbaea1966"


def reviewed(text: str, sha256: str, tables: Sequence[str] = ()) -> list[str]:
    """The SELECT statements of a text whose digest is the reviewed one [K27]. tables: what each must read, in order."""
    if hashlib.sha256(text.encode()).hexdigest() != sha256:
        raise ValueError("the text is not the reviewed one")
    lines = (x for x in text.splitlines() if not x.lstrip().startswith("--"))
    statements = [x.strip() for x in "\n".join(lines).split(";") if x.strip()]
    if any(not x.upper().startswith(("SELECT ", "WITH ")) for x in statements):
        raise ValueError("only reads are reviewed")
    if tables and (len(statements) != len(tables) or any(t not in x for t, x in zip(tables, statements, strict=True))):
        raise ValueError("the statements read other tables")
    return statements


def bound(spark: SparkSession, sql: str, args: Mapping[str, Any] | Sequence[Any], **frames: DataFrame) -> DataFrame:
    """A statement with parameter markers (`:name` or `?`); values are never put into its text [B15]."""
    return spark.sql(sql, args=args if isinstance(args, Mapping) else list(args), **frames)


def compile_only(spark: SparkSession, statements: Mapping[str, str], args: Mapping[str, Any] | None = None) -> dict[str, str]:
    """Names and errors of the statements that cannot be planned; nothing is run [K28]."""
    failed = {}
    for name, sql in statements.items():
        try:
            plan = spark.sql(f"EXPLAIN {sql.strip().rstrip(';')}", args=dict(args or {})).first()[0]
            if plan.startswith("Error occurred"):
                raise ValueError(plan)
        except Exception as error:
            failed[name] = " ".join(str(error).split())[:300]
    return failed


def verdict(health: DataFrame, window_anomalies: DataFrame, stored: Mapping[str, tuple[DataFrame, Sequence[str]]], rejects: DataFrame) -> DataFrame:
    """One row: what the run left open, and `pass` if that is nothing [K26].

    Passes only if every attempt is RECONCILED, no window is anomalous, no key repeats, and the
    rejects of the health view are as many as the rejects view has. stored: tables and their
    keys, by name. All checks are one grouping: each input is read once and leaves a row for each
    check and task, or for each key where keys must not repeat.
    """
    names = ["batch_anomalies", "other", "attempts", "health_rejects", "window_anomalies", "view_rejects"]

    def lines(rows: DataFrame, check: str, keys: Sequence[str] = (), **counts: Column) -> DataFrame:
        key = F.array(*(F.col(k).cast("string") for k in keys)).cast("array<string>")
        return rows.select(F.lit(check).alias("check"), key.alias("key"), *(counts.get(name, F.lit(0)).cast("long").alias(name) for name in names))

    status = F.col("health_status")
    every = lines(health, "health", batch_anomalies=~status.isin("RECONCILED", "PENDING_PROCESS"), other=status != "RECONCILED", attempts=F.lit(1), health_rejects=F.coalesce("rejected_rows", F.lit(0)))
    every = every.union(lines(window_anomalies, "windows", window_anomalies=F.lit(1))).union(lines(rejects, "rejects", view_rejects=F.lit(1)))
    for name, (rows, keys) in stored.items():
        every = every.union(lines(rows, name, keys))
    grouped = every.groupBy("check", "key").agg(F.count("*").alias("rows"), *(F.sum(name).alias(name) for name in names))
    repeated = [F.count_if((F.col("check") == name) & (F.col("rows") > 1)).alias(f"duplicate_{name}") for name in stored]
    row = grouped.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names), *repeated)
    clean: Column = (F.col("attempts") > 0) & (F.col("other") == 0) & (F.col("window_anomalies") == 0) & (F.col("health_rejects") == F.col("view_rejects"))
    for name in stored:
        clean = clean & (F.col(f"duplicate_{name}") == 0)
    return row.withColumn("verdict", F.when(clean, "pass").otherwise("review")).drop("other", "attempts")
