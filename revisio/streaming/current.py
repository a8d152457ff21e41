"""The current revision of each event kept as state, as revisions arrive late, twice and out of order [E1, I9, I10, K11].

State holds one row for each event: the revision that wins so far, deleted ones included. A
deletion is a revision like others and stays as a tombstone, so that the replay of an older file
finds a later revision in its way. Only a revision that beats the one held is passed on, so that
the log of changes has no row for stale or repeated ones, and the last change of each event is
its current revision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from revisio.operators import revisions

KEY = "canonical_event_id"
#: What a later revision is told by, most significant first; nulls come before all values.
ORDER = ("source_updated_at", "fetched_at", "payload_hash", "stage_file_name", "stage_file_row_number")
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_for(spark: SparkSession) -> SparkSession:
    """A session of its own that keeps state beside the heap; the caller's settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        if (value := spark.conf.get(key, None)) is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    return own


def changes(stream: DataFrame) -> DataFrame:
    """A stream of revisions to the stream of those that became current: a grouped maximum, which Spark keeps as state.

    Of equal revisions the one that came first holds. A batch passes the winners on that came with it.
    """
    now = F.unix_micros(F.current_timestamp())  # one instant a batch
    told = F.struct(*ORDER, (-F.col("came_at")).alias("came_at"))
    best = stream.withColumn("came_at", now).groupBy(KEY).agg(F.max_by(F.struct(*(c for c in stream.columns if c != KEY), "came_at"), told).alias("best"))
    names = (F.col(KEY) if c == KEY else F.col("best")[c].alias(c) for c in stream.columns)
    return best.where(F.col("best")["came_at"] == now).select(*names)


def maintain(spark: SparkSession, folder: str, schema: StructType, log: str, checkpoint: str, files_per_batch: int = 200) -> StreamingQuery:
    """Run the revisions of a folder's files that are new through the state, into a Parquet log of changes.

    A batch writes its own part of the log, named by its number, so that a batch that is run again replaces what it wrote.
    """
    own = session_for(spark)
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return changes(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    """Current events as the log's last changes say; deleted ones are gone."""
    return revisions.current(spark.read.schema(schema).parquet(log).drop("batch"))
