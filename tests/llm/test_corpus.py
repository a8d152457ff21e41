"""The corpus pipeline: each stage on small tables with planted cases, and the whole run."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm import SF, brute_near_copies, reference_ids

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A folder of documents with planted cases and the labels of the larger table."""
    folder = tmp_path_factory.mktemp("sf")
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    words = [f"w{k}" for k in range(60)]
    near = [*words[:30], "changed", *words[31:]]
    secret = 'api: token = "4b579d3cee1dcaf48e80dfd04d785e892fc7d365" end'
    rows = [(10_001, " ".join(words), "en", "web", None), (10_002, " ".join(near), "en", "web", None), (10_003, " ".join(words), None, None, None), (10_004, secret, "en", "code", len(secret)), (10_005, None, None, "web", None), (10_006, "", "en", None, 0), (None, "no id here", "en", "web", 10)]
    base.unionByName(spark.createDataFrame(rows, DOCS)).write.parquet(f"file://{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"file://{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_stages_are_those_that_are_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "secret scans", "mixing", "best-fit packing"] and corpus_pipeline.ORACLE_SQL is None


def test_toxicity_stage(spark, sf, docs):
    kept = STAGES["toxicity"](spark, docs, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    ids = kept.select("doc_id").withColumn("kept", F.lit(1))
    rows = docs.join(labels, "doc_id").join(ids, "doc_id", "left").select("toxic", "kept").collect()
    assert kept.columns == docs.columns
    assert sum(not r.kept for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)  # some labels are turned around
    assert sum(not r.kept for r in rows if not r.toxic) <= 0.01 * len(rows)
    assert {10_001, 10_004, 10_005, 10_006, None} <= {r.doc_id for r in kept.collect()}


def test_near_dedup_stage(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, first = brute_near_copies(rows), {}
    for (i, _), k in zip(rows, want, strict=True):
        first[k] = min(first.get(k, (True, 0)), (i is None, i or 0))
    kept = STAGES["simhash near-dedup"](spark, docs, sf)
    assert kept.columns == docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(first.values())
    assert {10_002, 10_003} & {r.doc_id for r in kept.collect()} == set()


def test_secret_stage(spark, sf, docs):
    out = {r.doc_id: r for r in STAGES["secret scans"](spark, docs, sf).collect()}
    assert len(out) == docs.count() and out[10_004].text == 'api: token = "[SECRET]" end' and out[10_004].n_chars == len(out[10_004].text)
    assert not any(re.search(r'token = "[0-9a-f]{40}"', r.text or "") for r in out.values()) and out[10_005].text is None


def test_mixing_stage(spark, sf, docs):
    from revisio.llm import mixing

    out = STAGES["mixing"](spark, docs, sf)
    told = mixing.digests(docs).agg(F.sum("taken"), F.sum("size")).first()
    assert out.columns == docs.columns and out.select(F.sum(mixing.words(F.col("text")))).first()[0] == told[0] and abs(told[0] - told[1]) <= 10
    again = STAGES["mixing"](spark, docs, sf)
    assert sorted(out.collect(), key=repr) == sorted(again.collect(), key=repr)


def test_packing_stage(spark, sf):
    small = spark.read.parquet(f"{SF}/documents.parquet")
    rows = STAGES["best-fit packing"](spark, small, sf).collect()
    assert sum(r.length for r in rows) == sum(len(reference_ids(r.text)) for r in small.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_on_odd_and_empty_tables(spark, sf, name):
    """Nulls in all columns, repeated rows, columns whose names stages use themselves, and no rows."""
    names = {"node": 1, "root": "x", "mix_own": 2.0, "key": "k", "score": 0.5}
    odd = spark.createDataFrame([(None,) * 5, (1, "a b", None, None, 3), (1, "a b", None, None, 3), (2, "", "en", "s", 0), (3, " \t", "en", "s", 2)], DOCS).withColumns({k: F.lit(v) for k, v in names.items()})
    out = STAGES[name](spark, odd, sf)
    assert out.count() >= (2 if name != "mixing" else 1)
    if name != "best-fit packing":
        assert out.columns == odd.columns and {r.mix_own for r in out.collect()} == {2.0}
    assert STAGES[name](spark, odd.where("false"), sf).count() == 0


def test_whole_run(spark, sf):
    """What is packed at the end is the text that all stages kept, once for each time that the mix takes it."""
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r.doc_id for r in rows}.isdisjoint({10_002, 10_003})
    fills = {}
    for r in rows:
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fills.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
