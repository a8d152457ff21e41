"""Lineage cuts in storage that every executor and the driver share.

A cut writes a DataFrame as Parquet below the folder named by
``spark.checkpoint.dir`` and reads it back. A lost executor then costs a re-read
of files, never a recomputation of the whole lineage. Parquet is used instead of
``DataFrame.checkpoint`` because it is columnar and compressed, so that a later
stage can prune columns of the cut.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master without a setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="revisio-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_ROOTS: list[str] = []


def clean(spark: SparkSession) -> int:
    """Remove the cuts of all queries so far; returns how many folders went.

    A result is read lazily from its cuts, so that only its reader knows when they can go; what
    is left goes when the driver ends.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _ROOTS:
        path = jvm.org.apache.hadoop.fs.Path(_ROOTS.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


@atexit.register
def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _ROOTS:
        with contextlib.suppress(Exception):  # the session may be gone by now
            clean(spark)


class Scratch:
    """A folder of named cuts, private to one query."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        _ROOTS.append(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def cut(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = self.path(name)
        df.write.options(**options).parquet(path)
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove cuts that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def configure(spark: SparkSession, timeout_s: int = 600) -> SparkSession:
    """Session settings that results rest on [A27]: UTC, checked casts, adaptive plans, a limit for broadcasts."""
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.broadcastTimeout": str(timeout_s)}.items():
        spark.conf.set(key, value)
    return spark


def functions_like(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the session's functions that match a pattern."""
    return sorted(r.function for r in spark.sql("SHOW FUNCTIONS").where(F.col("function").like(pattern)).collect())


def run_metrics(spark: SparkSession, group: str) -> dict[str, int]:
    """Jobs, stages and tasks, done and failed, of a job group: what a run has used [A25]."""
    tracker, out = spark.sparkContext.statusTracker(), {"jobs": 0, "stages": 0, "tasks": 0, "done_tasks": 0, "failed_tasks": 0}
    for job in tracker.getJobIdsForGroup(group):
        out["jobs"] += 1
        for k in getattr(tracker.getJobInfo(job), "stageIds", ()):
            if stage := tracker.getStageInfo(k):
                out["stages"] += 1
                out["tasks"] += stage.numTasks
                out["done_tasks"] += stage.numCompletedTasks
                out["failed_tasks"] += stage.numFailedTasks
    return out
