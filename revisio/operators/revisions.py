"""Revision history: de-duplication, current state, re-keying [K5, K7, K11]."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisio.schema import REVISION_KEY, SITES


def dedup(observations: DataFrame) -> DataFrame:
    """One row per revision key: the latest by (fetched_at, file, row) [K5]. A partial aggregate, no window."""
    rest = [c for c in observations.columns if c not in REVISION_KEY]
    last = F.max_by(F.struct(*rest), F.struct("fetched_at", "stage_file_name", "stage_file_row_number"))
    return observations.groupBy(*REVISION_KEY).agg(last.alias("r")).select(*REVISION_KEY, "r.*")


def conflicting_rows(observations: DataFrame) -> DataFrame:
    """File rows that carry more than one revision; a load with any is refused."""
    return observations.select("stage_file_name", "stage_file_row_number", *REVISION_KEY).distinct().groupBy("stage_file_name", "stage_file_row_number").count().where("count > 1")


def refuse_conflicts(observations: DataFrame) -> DataFrame:
    """The observations, if each file row carries one revision [K5]."""
    first = conflicting_rows(observations).first()
    if first is not None:
        raise ValueError(f"file row {first.stage_file_name}:{first.stage_file_row_number} carries {first['count']} revisions")
    return observations


def duplicate_groups(rows: DataFrame, keys: Sequence[str]) -> int:
    """Keys that more than one row has [D7]."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").count()


def current(facts: DataFrame) -> DataFrame:
    """The latest revision of each event; then, and only then, deleted ones go [E1, K11]."""
    latest = Window.partitionBy("canonical_event_id").orderBy(*(F.col(c).desc() for c in ("source_updated_at", "fetched_at", "payload_hash", "stage_file_name", "stage_file_row_number")))
    return facts.withColumn("revision_rank", F.row_number().over(latest)).where("revision_rank = 1").where("source_status <> 'deleted'").drop("revision_rank")


_RANK = ("fetched_at", "stage_file_name", "stage_file_row_number", "canonical_event_id")


def _count(flag: Column) -> Column:
    return F.count_if(F.coalesce(flag, F.lit(False)))


PROBLEMS = ("no canonical id", "one id in two groups", "repeated fact key", "bridge without a fact", "repeated bridge key", "bridges collide", "winner lacks a site")


def rekey_problems(facts: DataFrame, bridges: DataFrame, canonical: DataFrame, sites: Sequence[str] = tuple(s[0] for s in SITES)) -> DataFrame:
    """(problem, n) of what stops a re-keying, without those that do not occur [K7].

    facts without a new id; old ids that fall into two groups; repeated fact keys; bridge rows
    without a fact; repeated bridge keys; bridge rows that would meet under one new key; facts
    that win a collision but lack a site.

    canonical has a row for each source id. Each input is read once. Ranked facts and bridge rows meet in one grouping by revision key and
    site, and once more by revision key, whose rows then carry flags. What still needs another
    key (old id, new key and site) leaves as tagged groups of one more exchange, in which the
    flags travel along, summed before they do.
    """
    key, new_key = list(REVISION_KEY), ["new_id", "source_updated_at", "payload_hash"]
    new = canonical.select("source_event_id", F.col("canonical_id").alias("new_id"))
    mapped = facts.select("source_event_id", *key, *_RANK[:-1]).join(new, "source_event_id", "left")
    met = Window.partitionBy(*new_key)
    order = met.orderBy(*(F.col(c).desc() for c in _RANK))
    has = F.col("new_id").isNotNull()
    ranked = mapped.select(*key, "source_event_id", "new_id", F.when(has, F.row_number().over(order)).alias("rank"), F.when(has, F.count("*").over(met)).alias("met"))
    told = ranked.select(*key, F.lit(None).cast("string").alias("site_key"), "new_id", "rank", "met", F.lit(True).alias("fact"))
    both = told.unionByName(bridges.select(*key, "site_key"), allowMissingColumns=True)
    by_site = both.groupBy(*key, "fact", "site_key").agg(
        F.count("*").alias("rows"), F.count_if(F.col("fact") & F.col("new_id").isNull()).alias("unmapped"), F.min("new_id").alias("low"), F.max("new_id").alias("high"), F.min("rank").alias("rank"), F.max("met").alias("met")
    )
    is_fact = F.coalesce("fact", F.lit(False))
    by_key = by_site.groupBy(*key).agg(
        F.sum(F.when(is_fact, F.col("rows")).otherwise(0)).alias("facts"), F.sum("unmapped").alias("unmapped"), F.min("low").alias("new_id"), F.max("high").alias("high"), F.min("rank").alias("rank"), F.max("met").alias("met"),
        F.sum(F.when(is_fact, 0).otherwise(F.col("rows"))).alias("bridges"), F.count_if(~is_fact & (F.col("rows") > 1)).alias("repeated"), F.collect_list(F.when(~is_fact, F.col("site_key"))).alias("held"),
    )
    wins = F.coalesce(F.col("rank") == 1, F.lit(False))
    lacks = F.size(F.array_intersect("held", F.lit(list(sites)).cast("array<string>"))) < len(sites)
    orphan = F.col("rank").isNull()
    flags = {
        PROBLEMS[0]: F.col("unmapped"), PROBLEMS[2]: (F.col("facts") > 1).cast("long"), PROBLEMS[3]: F.when(orphan, F.col("bridges")).otherwise(0),
        PROBLEMS[4]: F.col("repeated"), PROBLEMS[6]: (wins & (F.col("met") > 1) & lacks).cast("long"),
    }
    sums = [F.sum(name).alias(name) for name in flags]

    def tagged(tag: str, group: Sequence[Column], low: Column, high: Column, own: dict[str, Column]) -> Column:
        """One group of the last exchange: low and high of what must be one, and the flags that travel along."""
        none = F.lit(0).cast("long")
        return F.struct(F.lit(tag).alias("tag"), F.struct(*group).alias("group"), low.alias("low"), high.alias("high"), *(own.get(name, none).cast("long").alias(name) for name in flags))

    nothing = [F.lit(None).cast("timestamp").alias("at"), *(F.lit(None).cast("string").alias(c) for c in ("hash", "site"))]
    old = tagged("old", [F.col("canonical_event_id").alias("id"), *nothing], F.col("new_id"), F.col("high"), flags)
    at = [F.col("new_id").alias("id"), F.col("source_updated_at").alias("at"), F.col("payload_hash").alias("hash")]
    held = F.when(wins, F.col("held")).otherwise(F.array().cast("array<string>"))
    won = F.transform(held, lambda site: tagged("new", [*at, site.alias("site")], F.col("canonical_event_id"), F.col("canonical_event_id"), {}))
    grouped = by_key.select(F.inline(F.concat(F.array(old), won))).groupBy("tag", "group").agg(F.min("low").alias("low"), F.max("high").alias("high"), *sums)
    apart = F.col("low") != F.col("high")
    row = grouped.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags), _count((F.col("tag") == "old") & apart).alias(PROBLEMS[1]), _count((F.col("tag") == "new") & apart).alias(PROBLEMS[5]))
    found = row.select(F.inline(F.array(*(F.struct(F.lit(name).alias("problem"), F.col(name).cast("long").alias("n")) for name in PROBLEMS))))
    return found.where("n > 0")


def rekey_checked(facts: DataFrame, bridges: DataFrame, canonical: DataFrame, sites: Sequence[str] = tuple(s[0] for s in SITES)) -> tuple[DataFrame, DataFrame, int]:
    """As `rekey`, with the number of old ids that move; any problem stops it before a row is written."""
    problems = rekey_problems(facts, bridges, canonical, sites).collect()
    if problems:
        raise ValueError("; ".join(f"{r.problem}: {r.n}" for r in problems))
    moves = facts.join(canonical, "source_event_id").where("canonical_event_id <> canonical_id").agg(F.count_distinct("canonical_event_id")).first()[0]
    return (*rekey(facts, bridges, canonical), moves)


def rekey(facts: DataFrame, bridges: DataFrame, canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts and bridges under new canonical ids (columns source_event_id, canonical_id) [K7].

    Of facts that fall on one key the latest by (fetched_at, file, row, old id) stays; its
    bridge rows move with it and the others' go. A fact without a new id fails the query.
    """
    new = canonical.select("source_event_id", F.col("canonical_id").alias("new_id"))
    moved = facts.join(new, "source_event_id", "left").withColumn("new_id", F.coalesce("new_id", F.raise_error(F.concat(F.lit("no canonical id for "), "source_event_id")).cast("string")))
    order = Window.partitionBy("new_id", "source_updated_at", "payload_hash").orderBy(*(F.col(c).desc() for c in ("fetched_at", "stage_file_name", "stage_file_row_number", "canonical_event_id")))
    kept = moved.withColumn("rk", F.row_number().over(order)).where("rk = 1").drop("rk")
    old_to_new = kept.select(*REVISION_KEY, "new_id")
    columns = [F.col("new_id").alias("canonical_event_id") if c == "canonical_event_id" else F.col(c) for c in facts.columns]
    placed = bridges.join(old_to_new, list(REVISION_KEY))
    return kept.select(*columns), placed.select(*(F.col("new_id").alias(c) if c == "canonical_event_id" else F.col(c) for c in bridges.columns))
