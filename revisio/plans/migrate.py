"""Parser migration: relabel stored rejects by a join with RAW and lift versions, in one commit [K25]."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.operators import merge
from revisio.plans.store import Store
from revisio.schema import FILE_ROW

State = Mapping[tuple[str | None, str | None], int]


def state(staging: DataFrame) -> dict[tuple[str | None, str | None], int]:
    """Rows by parser version and reject reason: a handful of groups."""
    return {(r.staging_parser_version, r.reject_reason): r.n for r in staging.groupBy("staging_parser_version", "reject_reason").agg(F.count("*").alias("n")).collect()}


def is_stub(payload: str = "payload") -> Column:
    """RAW payloads whose time, magnitude and status are all JSON null or missing."""
    void = lambda f: F.coalesce(F.schema_of_variant(F.try_variant_get(payload, f"$.properties.{f}", "variant")), F.lit("VOID")) == "VOID"
    return void("time") & void("mag") & void("status")


def relabelled(staging: DataFrame, raw: DataFrame, old: str, new: str, condition: Column) -> DataFrame:
    """Staging rows of the old reason whose RAW row meets the condition get the new one; `relabelled` marks them."""
    hits = raw.where(condition).select(*FILE_ROW, F.lit(new).alias("label"))
    out = merge.update_from(staging.withColumn("relabelled", F.lit(False)), hits.withColumn("hit", F.lit(True)), list(FILE_ROW), {"reject_reason": "label", "relabelled": "hit"}, F.col("t.reject_reason") == old)
    return out


def migrate(store: Store, *, old_version: str, new_version: str, old_reason: str, new_reason: str, expected: State) -> str:
    """Relabel and lift a store whose staging is exactly in the expected state of the old version.

    expected: rows by (version, reason) before. Every row of the old reason must be a stub in
    RAW, and no accepted row may lie at the placeholder 0, 0. A store that is migrated already
    is left alone; any other state stops it. All counts are checked before the commit.
    """
    after = {(new_version, new_reason if reason == old_reason else reason): n for (_, reason), n in expected.items()}
    staging, facts = store.read("stg_event_revision"), store.read("fact_event_revision")
    versions = {r.staging_parser_version: r.n for r in facts.groupBy("staging_parser_version").agg(F.count("*").alias("n")).collect()}
    seen = state(staging)
    if seen == after and set(versions) <= {new_version}:
        return "migrated already"
    if seen != dict(expected) or set(versions) - {old_version}:
        raise ValueError(f"the stored state is not the expected one: {seen}, facts {versions}")
    if staging.where("reject_reason IS NULL AND longitude = 0 AND latitude = 0").limit(1).count():
        raise ValueError("an accepted row lies at the placeholder")
    rejects = sum(n for (_, reason), n in expected.items() if reason == old_reason)
    lifted = relabelled(staging, store.read("raw_event_records"), old_reason, new_reason, is_stub())
    lifted = merge.checked(lifted, rejects, "relabelled rejects", F.col("relabelled")).drop("relabelled").withColumn("staging_parser_version", F.lit(new_version))
    tx = store.transaction()
    tx.replace("stg_event_revision", merge.checked(lifted, sum(expected.values()), "versioned staging rows"))
    tx.replace("fact_event_revision", merge.checked(facts.withColumn("staging_parser_version", F.lit(new_version)), sum(versions.values()), "versioned facts"))
    if state(tx.read("stg_event_revision")) != after:
        raise ValueError("the state after the migration is not the expected one")
    tx.commit()
    return f"relabelled {rejects} of {sum(expected.values())} staging rows"
