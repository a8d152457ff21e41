"""Briefs of aggregated cases: prompt, fact screen, validation, hash and cache [J5-J8]."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisio.schema import RADIUS_KM, SITES

#: Words of hazard and action, claims of coverage, as patterns.
HAZARD = r"\b(risk|shaking|damage|evacuat\w*|shelter|safe|danger|should|alert)\b"
COVERAGE = r"\b(complete|all|every|guaranteed)\s+(source\s+)?coverage\b"
RADIUS = f"{RADIUS_KM:g} km"


def site_name(site_key: Column) -> Column:
    name = F.lit(None).cast("string")
    for key, title, *_ in SITES:
        name = F.when(site_key == key, title).otherwise(name)
    return name


def facts() -> dict[str, Column]:
    """The phrases that a brief of a case must hold, over columns as site_window_aggregates names them."""
    text = lambda c: F.col(c).cast("string")
    site = site_name(F.col("site_key"))
    return {
        "site": site, "event count": F.concat(text("event_count"), F.lit(" events")), "radius": F.lit(RADIUS), "event ID": F.col("nearest_event_id"),
        "distance": F.concat(text("nearest_distance_km"), F.lit(" km from "), site), "magnitude": F.concat(F.lit("magnitude "), text("nearest_magnitude")),
        "source status": F.col("nearest_source_status"), "record age": F.concat(text("nearest_record_age_hours"), F.lit(" hours")), "sample scope": F.lit("modeled"),
    }


def prompt() -> Column:
    """Instruction for one sentence from a case's facts alone."""
    f = facts()
    given = F.concat_ws("; ", *(F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("none"))) for name, value in f.items()))
    rules = "Write one sentence with these facts and no others. Say that the sample is modeled. No heading, no advice, nothing on hazard or on complete coverage. "
    return F.concat(F.lit(rules), given)


def template() -> Column:
    """The deterministic brief of a case: what is said where no model is called."""
    f = facts()
    return F.concat(
        F.lit("In the modeled "), f["site"], F.lit(" sample "), f["event count"], F.lit(f" were within {RADIUS}; the nearest event "), f["event ID"], F.lit(" was "), f["distance"], F.lit(", "),
        f["magnitude"], F.lit(", source status "), f["source status"], F.lit(", and its source record was "), f["record age"], F.lit(" old."),
    )


def problems(message: Column) -> Column:
    """Array of what is wrong with a brief; empty if nothing is [J6]. Commas and case do not count."""
    low = F.replace(F.lower(message), F.lit(","), F.lit(""))
    checks = [F.when(~F.coalesce(F.contains(low, F.lower(value)), F.lit(False)), f"missing or misstated {name}") for name, value in facts().items()]
    own = F.concat(F.lit(r"\baway from\s+\Q"), F.lower("nearest_event_id"), F.lit(r"\E\b"))  # lower case has no end of the quote
    anchored = F.coalesce(F.regexp_like(low, own), F.lit(False))
    checks += [
        F.when(low.rlike(HAZARD), "hazard or action language"), F.when(low.rlike(COVERAGE), "unsupported coverage claim"),
        F.when(anchored, "distance anchored to event ID"), F.when(~F.endswith(F.rtrim(message), F.lit(".")), "incomplete ending"),
    ]
    return F.when(message.isNull(), F.array(F.lit("no brief"))).otherwise(F.array_compact(F.array(*checks)))


def aggregate_problems(cases: DataFrame, expected: Iterable[str]) -> DataFrame:
    """(case_id, problem) of aggregates that are no valid input [J8]: unknown, repeated or absent cases, sites, radii, counts, nearest events."""
    want = cases.sparkSession.createDataFrame([(c,) for c in sorted(set(expected))], "want string")
    both = cases.join(F.broadcast(want), F.col("case_id") == F.col("want"), "full")
    per_case = cases.groupBy(F.col("case_id").alias("repeated")).agg(F.count("*").alias("n")).where("n > 1")
    n, near = F.col("event_count"), F.col("nearest_event_id")
    checks = F.array_compact(F.array(
        F.when(F.col("case_id").isNull(), "absent"), F.when(F.col("want").isNull(), "unknown case"),
        F.when(F.col("case_id").isNotNull() & ~F.coalesce(F.col("site_key").isin(*(s[0] for s in SITES)), F.lit(False)), "unknown site"),
        F.when(F.col("case_id").isNotNull() & ~F.coalesce((F.col("radius_km") == RADIUS_KM) & (F.col("distinct_radii") == 1), F.lit(False)), "radius"),
        F.when(F.col("case_id").isNotNull() & ~F.coalesce(n >= 0, F.lit(False)), "count"),
        F.when((n == 0) & near.isNotNull(), "nearest event of none"), F.when((n > 0) & near.isNull(), "no nearest event"),
    ))
    told = both.select(F.coalesce("case_id", "want").alias("case_id"), F.explode(checks).alias("problem"))
    return told.union(per_case.select("repeated", F.lit("repeated case")))


def with_hash(cases: DataFrame) -> DataFrame:
    """Adds input_sha256 over the case's columns in order of their names: the key of its brief."""
    return cases.withColumn("input_sha256", F.sha2(F.to_json(F.struct(*sorted(cases.columns)), {"ignoreNullFields": "false"}), 256))


class Cache:
    """Briefs by input hash in a JSON file; a rejected or failed one may be asked for once more [J7]."""

    def __init__(self, path: Path, model: str):
        self.path, self.model = Path(path), model
        self.results: dict[str, dict[str, Any]] = {}
        if self.path.exists():
            stored = json.loads(self.path.read_text(encoding="utf-8"))
            if stored.get("model") != model or not isinstance(stored.get("results"), dict):
                raise ValueError("the cache is of another model or malformed")
            self.results = stored["results"]

    def save(self) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        whole = self.path.with_name(self.path.name + ".tmp")
        whole.write_text(json.dumps({"model": self.model, "results": self.results}, indent=1, sort_keys=True), encoding="utf-8")
        os.replace(whole, self.path)

    def pending(self, hashes: Iterable[str]) -> list[str]:
        return [h for h in hashes if h not in self.results]

    def may_retry(self, key: str) -> bool:
        told = self.results.get(key)
        return bool(told) and told["status"] in ("rejected", "error") and "retry" not in told

    def record(self, key: str, result: Mapping[str, Any]) -> None:
        """A first result, or the one retry of a rejected or failed one; anything else is refused."""
        if key not in self.results:
            self.results[key] = dict(result)
        elif self.may_retry(key):
            self.results[key]["retry"] = dict(result)
        else:
            raise ValueError("this input has its result, or has used its retry")
        self.save()


def write_briefs(cases: DataFrame, cache: Cache, complete: Callable[[str], str] | None = None, retry: Iterable[str] = ()) -> DataFrame:
    """Ask for the briefs that the cache lacks, screen them, keep them; returns case_id, input_sha256, status, message, problems.

    cases: a bounded list (a few literal cases). complete: prompt to text; the template's text
    if not given. retry: case ids to ask for once more. Input hashes are taken anew, so that a
    brief never stands for other facts.
    """
    keyed = with_hash(cases).select("*", prompt().alias("prompt"), template().alias("template"))
    rows = keyed.select("case_id", "input_sha256", "prompt", "template").collect()
    fresh = set(cache.pending(r.input_sha256 for r in rows))
    again = {r.input_sha256 for r in rows if r.case_id in set(retry)}
    if refused := sorted(r.case_id for r in rows if r.input_sha256 in again and not cache.may_retry(r.input_sha256)):
        raise ValueError(f"no retry is left for {', '.join(refused)}")
    answers = []
    for r in rows:
        if r.input_sha256 in fresh | again:
            try:
                answers.append((r.case_id, r.template if complete is None else complete(r.prompt), None))
            except Exception as error:
                answers.append((r.case_id, None, type(error).__name__))
    spark = cases.sparkSession
    asked = spark.createDataFrame(answers, "case_id string, message string, error string")
    screened = asked.join(keyed, "case_id").select("case_id", "input_sha256", "message", "error", problems(F.col("message")).alias("problems")).collect()
    for r in sorted(screened):
        cache.record(r.input_sha256, {"status": "error" if r.error else "rejected" if r.problems else "accepted", "message": r.message, "problems": r.problems, "error": r.error})
    last = [(r.case_id, r.input_sha256, (told := cache.results[r.input_sha256].get("retry", cache.results[r.input_sha256]))["status"], told["message"], told["problems"]) for r in rows]
    return spark.createDataFrame(last, "case_id string, input_sha256 string, status string, message string, problems array<string>")

