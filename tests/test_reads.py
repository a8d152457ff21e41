"""What an attempt reads of the stored tables."""

from pyspark.sql import functions as F

from revisio.plans import pipeline
from revisio.schema import REVISION_KEY
from tests.test_pipeline import feature, land, store  # noqa: F401  a fixture


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_an_attempt_reads_its_own_rows_and_merges_its_own_keys(store, tmp_path):  # noqa: F811
    for k in range(3):
        land(store, tmp_path, f"a{k}", [feature(f"e{k}"), feature("shared", updated=k)], k)
        pipeline.process_attempt(store, f"a{k}")
    raw = store.read("raw_event_records").where(F.col("attempt_id") == "a1")
    assert "PartitionFilters: [isnotnull(attempt_id" in plan(raw) and raw.count() == 2 and store.read("raw_event_records").count() == 6
    assert store.read("raw_event_records").columns[:3] == ["logical_batch_id", "attempt_id", "window_id"]

    facts = store.read("fact_event_revision")
    keys = store.spark.createDataFrame(facts.where("canonical_event_id = 'shared'").select(*REVISION_KEY).limit(2).collect())
    some = store.read("fact_event_revision", matching=keys)
    assert sorted(map(str, some.collect())) == sorted(map(str, facts.join(keys, list(REVISION_KEY), "left_semi").collect())) and some.count() == 2
    text = some._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == text.count("Relation [") and text.index("Aggregate") < text.index("LeftSemi")  # segments shrink before they meet
