"""Incremental landing: each new attempt folder once, by the batch load's own path."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revisio.plans.store import Store
from revisio.sources import landing


def ingest(store: Store, folder: str, checkpoint: str, receipt_of: Callable[[str], dict[str, Any]], now: Callable[[], Any]) -> StreamingQuery:
    """An availableNow stream of `folder/*/events.jsonl`. Only file names reach the driver, a bounded number per batch."""
    files = store.spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", 200).load(f"{folder}/*/events.jsonl").select(F.col("_metadata.file_path").alias("file"))

    def each(batch: DataFrame, _: int) -> None:
        for row in batch.distinct().orderBy("file").collect():
            receipt = receipt_of(row.file)
            if not store.read("batch_attempt").where(F.col("attempt_id") == receipt["attempt_id"]).limit(1).count():
                landing.load(store, row.file, receipt, now())

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
