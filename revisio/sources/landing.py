"""Landing of attempt files into RAW [A5-A13, K23]."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime
from itertools import pairwise
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revisio.plans.store import Store
from revisio.schema import RAW_PARSER_VERSION


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, characters as they are: the text that hashes are taken of."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


_PLACED = "file string, begin bigint, line string, place bigint"


def _place_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each split, which a task reads one after another."""
    now, seen = (None, None), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        files, begins = batch.column("file").dictionary_encode(), batch.column("begin").to_numpy()
        names, codes = files.dictionary, files.indices.to_numpy()
        new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (begins[1:] != begins[:-1])))
        place = np.arange(len(begins), dtype=np.int64)
        for at, upto in pairwise([*new.tolist(), len(begins)]):
            own = (names[int(codes[at])].as_py(), int(begins[at]))
            seen = seen if own == now else 0
            place[at:upto] += seen - at
            now, seen = own, seen + upto - at
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("begin"), batch.column("line"), pa.array(place)], ["file", "begin", "line", "place"])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, line): all lines of text files with their numbers from 1, blank ones included [A10, H11].

    Files split: each split's task numbers its own lines. A first pass counts the lines of each
    split, and the sum of what stands before it in its file is added to its numbers: a row for
    each split is all that meets. A split that the first pass has not seen fails the query.
    """
    own = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin")
    lines = spark.read.text(path, lineSep="\n").select(*own, F.col("value").alias("line"))
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("file", "begin").agg(F.count("*").alias("n")).select("file", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = lines.mapInArrow(_place_lines, _PLACED).join(counts, ["file", "begin"], "left")
    shift = F.coalesce("before", F.raise_error(F.concat(F.lit("a split was not counted: "), "file")).cast("bigint"))
    return placed.select("file", (F.col("place") + shift + 1).alias("number"), "line")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of envelope files, with its file and its number from 1 [A10, H11].

    Files of any size: they are read in splits. A line that is no JSON fails the load.
    """
    lines = numbered_lines(spark, path).where("trim(line) <> ''")
    v = F.parse_json("line")
    meta = lambda name, kind="string": F.variant_get(v, f"$.metadata.{name}", kind)
    return lines.select(
        meta("logical_batch_id").alias("logical_batch_id"), meta("attempt_id").alias("attempt_id"), meta("window_id").alias("window_id"), F.variant_get(v, "$.source_feature", "variant").alias("payload"),
        F.to_timestamp(meta("fetched_at")).alias("fetched_at"), meta("payload_hash").alias("payload_hash"), F.coalesce(meta("parser_version"), F.lit(RAW_PARSER_VERSION)).alias("parser_version"),
        F.regexp_extract("file", r"([^/]+/[^/]+)$", 1).alias("stage_file_name"), F.col("number").alias("stage_file_row_number"),
    )


def window_counts(rows: DataFrame) -> DataFrame:
    """Rows and fetch times of each window of landed rows [D13]."""
    return rows.groupBy("attempt_id", "window_id").agg(F.count("*").alias("window_rows"), F.count_distinct("fetched_at").alias("fetch_times"))


def batch_problems(rows: DataFrame, audit: DataFrame, attempt_id: str, logical_id: str | None = None) -> DataFrame:
    """(problem, n) of an attempt's rows against its audit, without those that do not occur [A8].

    rows: as `scan` gives them. audit: attempt_id, window_id, window_status, returned_rows. All
    rows of a window are of one fetch; rows name windows of the audit, as many as it says.
    """
    bad_row = (F.col("attempt_id") != attempt_id) | F.col("payload").isNull() | (F.length("payload_hash") != 64) | F.col("window_id").isNull() | F.col("fetched_at").isNull()
    if logical_id is not None:
        bad_row = bad_row | ~F.col("logical_batch_id").eqNullSafe(F.lit(logical_id))
    counts = rows.groupBy("window_id").agg(F.count("*").alias("window_rows"), F.count_distinct("fetched_at").alias("fetch_times"), F.count_if(F.coalesce(bad_row, F.lit(True))).alias("bad_rows"))
    leaves = audit.where((F.col("attempt_id") == attempt_id) & (F.col("window_status") == "reconciled")).select(F.col("window_id").alias("told"), "returned_rows")
    both = counts.join(leaves, F.col("window_id") == F.col("told"), "full")
    tests = {
        "rows lack metadata": F.sum(F.coalesce("bad_rows", F.lit(0))),
        "windows with several fetch times": F.count_if(F.col("fetch_times") > 1),
        "windows that no audit names": F.count_if(F.col("told").isNull()),
        "windows whose count differs": F.count_if(F.col("told").isNotNull() & (F.coalesce("window_rows", F.lit(0)) != F.col("returned_rows"))),
    }
    told = both.agg(*(F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(f"p{k}") for k, v in enumerate(tests.values())))
    listed = F.array(*(F.struct(F.lit(name).alias("problem"), F.col(f"p{k}").alias("n")) for k, name in enumerate(tests)))
    return told.select(F.inline(listed)).where("n > 0")


def stage(store: Store, path: str, attempt_id: str) -> str:
    """Copy an attempt's file to landing/<attempt id>/events.jsonl of the store; one that is there is never overwritten [A9]."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", attempt_id):
        raise ValueError("invalid attempt id")
    jvm, conf = store.spark.sparkContext._jvm, store.spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    source, target = at(path), at(f"{store.root}/landing/{attempt_id}/events.jsonl")
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(f"{attempt_id} is staged already")
    whole = at(f"{store.root}/landing/{attempt_id}/.events.jsonl.tmp")
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, whole, False, True, conf)
    if not fs.rename(whole, target):
        raise FileExistsError(f"{attempt_id} is staged already")
    return target.toString()


def load(store: Store, path: str, receipt: dict[str, Any], loaded_at: datetime) -> int:
    """Append an attempt's file and its receipt in one commit; an attempt that is loaded already is refused [A11, A12]."""
    attempt = receipt["attempt_id"]
    if not re.fullmatch(r"[A-Za-z0-9_-]+", attempt):
        raise ValueError("invalid attempt id")
    tx = store.transaction()
    for table in ("batch_attempt", "raw_event_records"):
        if tx.read(table).where(F.col("attempt_id") == attempt).limit(1).count():
            raise ValueError(f"{attempt} is in {table} already")
    rows = scan(store.spark, path).withColumn("loaded_at", F.lit(loaded_at))
    n, wrong = rows.agg(F.count("*"), F.count_if((F.col("attempt_id") != attempt) | F.col("payload").isNull() | (F.length("payload_hash") != 64))).first()
    if wrong or n != receipt["raw_rows_written"]:
        raise ValueError(f"{n} rows, {wrong} wrong, {receipt['raw_rows_written']} expected")
    tx.append("raw_event_records", rows)
    target = tx.read("batch_attempt")
    row = receipt | {"load_status": "complete", "loaded_rows": n, "recorded_at": loaded_at}
    variant = lambda value: F.parse_json(F.lit(None if value is None else json.dumps(value)))
    tx.append("batch_attempt", store.spark.range(1).select(*((variant(row.get(f.name)) if f.dataType.simpleString() == "variant" else F.lit(row.get(f.name)).cast(f.dataType)).alias(f.name) for f in target.schema)))
    tx.commit()
    return n
