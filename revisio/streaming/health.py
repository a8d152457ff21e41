"""Batch health as its parts arrive: receipts, row counts, process rows and batch facts in any order [C4, K15].

A grouping by attempt keeps what its four joins would find: the receipt, the sums of the counts
told so far, the latest process row and the fact. A batch that brings rows of an attempt passes its
joined row on, once the receipt is there, so that an attempt without counts, process or fact shows
at once, and nothing waits for a watermark. The state of a row of the log is told by the same rule
as that of the joins; an attempt's last row, the one that has seen most rows, is its health.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revisio.operators import views
from revisio.streaming.current import session_for

#: Columns of each part, beside attempt_id; counts are added up, of processes the greatest by (finished, id, ...) holds, of others one of the last batch that brought any.
PARTS = {
    "receipt": {"batch_kind": "string", "load_status": "string", "source_rows_returned": "bigint", "raw_rows_written": "bigint", "loaded_rows": "bigint", "receipt_gap_count": "bigint"},
    "count": {"raw_rows": "bigint", "staging_rows": "bigint", "staging_reject_rows": "bigint"},
    "process": {"finished": "bigint", "process_attempt_id": "string", "process_status": "string", "p_loaded_rows": "bigint", "processed_rows": "bigint", "rejected_rows": "bigint"},
    "fact": {"f_attempt_id": "string", "fact_process_status": "string", "f_processed_rows": "bigint", "f_rejected_rows": "bigint", "fetch_to_curated_seconds": "double"},
}
_COLUMNS = {name: kind for part in PARTS.values() for name, kind in part.items()}
_OUT = "attempt_id string, version bigint, " + ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


def part(frame: DataFrame, name: str) -> DataFrame:
    """A part's rows as the state reads them: its own columns and nulls for those of the others."""
    own = PARTS[name]
    return frame.select("attempt_id", F.lit(name).alias("part"), *((F.col(c) if c in own else F.lit(None)).cast(kind).alias(c) for c, kind in _COLUMNS.items()))


def joined(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Streams of parts, by name, to the stream of joined rows: one grouping, whose sums and greatest rows Spark keeps as state."""
    every = reduce(DataFrame.union, (part(frame, name) for name, frame in parts.items()))
    of = lambda name, what: F.when(F.col("part") == name, what)  # noqa: E731  null, which aggregates leave out, in other parts' rows
    whole = lambda name: of(name, F.struct(*PARTS[name]))
    held = every.withColumn("came_at", F.current_timestamp()).groupBy("attempt_id").agg(  # one instant a batch
        F.count("*").alias("version"), F.max_by(whole("receipt"), of("receipt", F.col("came_at"))).alias("receipt"), F.max(whole("process")).alias("process"), F.max_by(whole("fact"), of("fact", F.col("came_at"))).alias("fact"),
        *(F.coalesce(F.sum(of("count", F.coalesce(c, F.lit(0)))), F.lit(0)).alias(c) for c in PARTS["count"]),
    )
    return held.where("receipt IS NOT NULL").select("attempt_id", "version", "receipt.*", *PARTS["count"], "process.*", "fact.*")


def maintain(spark: SparkSession, folders: Mapping[str, str], log: str, checkpoint: str, files_per_batch: int = 200) -> StreamingQuery:
    """Run what is new in each part's folder of Parquet files through the state into a log; a batch that is run again replaces what it wrote."""
    own = session_for(spark)
    read = lambda name: own.readStream.schema("attempt_id string, " + ", ".join(f"{c} {kind}" for c, kind in PARTS[name].items())).option("maxFilesPerTrigger", files_per_batch).parquet(folders[name])

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return joined({name: read(name) for name in PARTS}).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def health(spark: SparkSession, log: str) -> DataFrame:
    """Each receipt's last joined row, and its state."""
    rows = spark.read.schema(_OUT).parquet(log)
    rest = [c for c in rows.columns if c not in ("attempt_id", "batch")]
    last = rows.groupBy("attempt_id").agg(F.max_by(F.struct(*rest), "version").alias("r")).select("attempt_id", "r.*")
    return last.withColumn("health_status", views.health_status(F.col("receipt_gap_count"))).drop("version", "f_attempt_id")
