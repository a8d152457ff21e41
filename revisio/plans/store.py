"""Snapshot catalog on plain Parquet [A16-A24, A28, L1-L7].

A table version is a list of segments, immutable folders of rows (and, for tables that are merged
by key, of keys that are gone). A write adds a segment of what it changes; TIER neighbours of one
level become one of the next, so that a row is rewritten as often as there are levels, not with
every write. Tables of `schema.MERGED` are merged by key as they are read: the last segment's row
of a key holds. A commit is one file, `commits/<n>.json`, made
exclusively, that names the folder of every table: it is the multi-table transaction, the
version for reads of the past, the compare-and-set of the state, and (copied) a clone.
Staged folders that no commit names are invisible; `vacuum` removes them. Row counts of
tables are never collected here, only folder names.

The catalog talks to its root through Hadoop's file system. A commit is written aside whole and
published by a link (local files) or a rename (others) that does not replace, so that a crash
between leaves nothing that a reader takes for a commit. A store whose renames replace needs a
lock service beside it. A commit whose publication failed without an answer is looked up by its own mark before
it is called lost.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.schema import BY_ATTEMPT, MERGED, TABLES

TIER = 8


class CommitConflict(RuntimeError):
    """Another commit took the version; nothing of this one is visible."""


class CommitUncertain(RuntimeError):
    """The store gave no answer to a commit and cannot be read: it may be visible or not."""


class Store:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str] = TABLES):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if self.version() < 0:
            self._publish(0, {"tables": {}, "state": {}})

    # ---- commits
    def version(self) -> int:
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return -1
        return max((int(s.getPath().getName().removesuffix(".json")) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")), default=-1)

    def commit_at(self, version: int | None = None) -> dict[str, Any]:
        n = self.version() if version is None else version
        stream = self._fs.open(self._path(f"{self.root}/commits/{n}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: int, commit: dict[str, Any]) -> None:
        mark = uuid.uuid4().hex
        target, aside = self._path(f"{self.root}/commits/{version}.json"), self._path(f"{self.root}/commits/.{version}-{mark}.tmp")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(commit | {"mark": mark}, sort_keys=True).encode()))
        finally:
            out.close()
        try:
            published = self._claim(aside, target)
        except Exception as error:
            published = self._holds(version, mark, error)
        if not published or not self._holds(version, mark):
            self._fs.delete(aside, False)
            raise CommitConflict(f"version {version} is taken")

    def _claim(self, aside, target) -> bool:
        """Give the target's name to the file aside, unless it is taken."""
        if self._fs.getScheme() != "file":
            return not self._fs.exists(target) and self._fs.rename(aside, target)
        try:
            os.link(aside.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        self._fs.delete(aside, False)
        return True

    def _holds(self, version: int, mark: str, error: Exception | None = None) -> bool:
        """True if the version is the commit of this mark."""
        try:
            return self._fs.exists(self._path(f"{self.root}/commits/{version}.json")) and self.commit_at(version).get("mark") == mark
        except Exception as unread:
            raise CommitUncertain(f"version {version} may be published or not") from error or unread

    # ---- reads
    def read(self, table: str, version: int | None = None, matching: DataFrame | None = None) -> DataFrame:
        """A table now or as of a version; empty with its schema where no commit has written it. matching: keys, or some columns of them, of the rows wanted."""
        return self._frame(self.commit_at(version), table, matching)

    def _frame(self, commit: dict[str, Any], table: str, matching: DataFrame | None = None) -> DataFrame:
        return self._merged(table, commit["tables"].get(table, []), matching).where("NOT gone").drop("gone")

    def _rows(self, table: str, folders: list[str]) -> DataFrame:
        """Rows of folders; those that hold a folder for each attempt are read one by one, as Spark asks of partitioned folders."""
        read, paths = self.spark.read.schema(self.tables[table]).parquet, [self.at(f) for f in folders]
        if table not in BY_ATTEMPT:
            return read(*paths)
        names = self.spark.createDataFrame([], self.tables[table]).columns
        return reduce(DataFrame.union, (read(path).select(*names) for path in paths))

    def _merged(self, table: str, segments: list[dict[str, Any]], matching: DataFrame | None = None) -> DataFrame:
        """Rows of segments, with gone: keys that a later segment took away, if no later one brought them back.

        matching: each segment keeps what agrees before segments meet, so that what is merged does not grow with the table.
        """
        schema, keys = self.tables[table], MERGED.get(table)
        some = (lambda frame: frame) if matching is None else (lambda frame: frame.join(matching, matching.columns, "left_semi"))
        rows = [s["rows"] for s in segments if s["rows"]]
        if not rows and not any(s.get("gone") for s in segments):
            return self.spark.createDataFrame([], schema).withColumn("gone", F.lit(False))
        if not keys or (len(segments) == 1 and not segments[0].get("gone")):
            return some(self._rows(table, rows)).withColumn("gone", F.lit(False))
        whole = self.spark.createDataFrame([], schema).withColumns({"gone": F.lit(False), "segment": F.lit(0)})
        for k, s in enumerate(segments):
            if s["rows"]:
                whole = whole.unionByName(some(self._rows(table, [s["rows"]])).withColumns({"gone": F.lit(False), "segment": F.lit(k)}))
            if s.get("gone"):
                lost = self.spark.read.schema(self.spark.createDataFrame([], schema).select(*keys).schema).parquet(self.at(s["gone"]))
                whole = whole.unionByName(some(lost).withColumns({"gone": F.lit(True), "segment": F.lit(k)}), allowMissingColumns=True)
        # Of one segment, rows come after what it takes away: a key may go and come back.
        last = F.max_by(F.struct(*(c for c in whole.columns if c not in keys and c != "segment")), F.struct("segment", ~F.col("gone")))
        return whole.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")

    def state(self, key: str) -> Any:
        return self.commit_at()["state"].get(key)

    def transaction(self) -> Transaction:
        return Transaction(self)

    def clone(self, root: str) -> Store:
        """A new catalog of the same folders; a catalog that exists already is refused."""
        if self._fs.exists(self._path(f"{root}/commits")):
            raise CommitConflict(f"{root} exists")
        now = self.commit_at()
        tables = {t: [x | {c: self.at(x[c]) for c in ("rows", "gone") if x.get(c)} for x in xs] for t, xs in now["tables"].items()}
        other = Store.__new__(Store)
        other.spark, other.root, other.tables, other._path, other._fs = self.spark, root.rstrip("/"), self.tables, self._path, self._fs
        other._publish(0, {"tables": tables, "state": now["state"]})
        return other

    def at(self, folder: str) -> str:
        """A folder of a commit as a path: relative ones are of this root, a clone's are whole."""
        return folder if "://" in folder or folder.startswith(("/", "file:")) else f"{self.root}/{folder}"

    def temporary_like(self, table: str, name: str, rows: DataFrame | None = None) -> str:
        """A session view with a table's columns, empty or with the given rows; the store does not know it [A23]."""
        frame = self.spark.createDataFrame([], self.tables[table])
        if rows is not None:
            frame = rows.select(*(rows[f.name].cast(f.dataType).alias(f.name) for f in frame.schema))
        frame.createOrReplaceTempView(name)
        return name

    def metadata(self) -> DataFrame:
        """One row per table: whether a commit has written it, its segments and columns [A24]."""
        now = self.commit_at()
        rows = [(t, t in now["tables"], len(now["tables"].get(t, [])), len(self.spark.createDataFrame([], schema).columns), self.version()) for t, schema in sorted(self.tables.items())]
        return self.spark.createDataFrame(rows, "table_name string, written boolean, segments int, columns int, version int")

    def drop(self) -> None:
        self._fs.delete(self._path(self.root), True)

    def vacuum(self) -> int:
        """Remove staged folders that no commit names; returns how many."""
        named = {x.get(c) for n in range(self.version() + 1) for xs in self.commit_at(n)["tables"].values() for x in xs for c in ("rows", "gone")}
        data, gone = self._path(f"{self.root}/data"), 0
        for s in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f"data/{s.getPath().getName()}" not in named:
                gone += bool(self._fs.delete(s.getPath(), True))
        return gone


class Transaction:
    """Stages table folders and state, then publishes them in one commit."""

    def __init__(self, store: Store):
        self.store, self.base = store, store.version()
        self.now = store.commit_at(self.base)

    def read(self, table: str, matching: DataFrame | None = None) -> DataFrame:
        """The table as this transaction has it; matching as in `Store.read`."""
        return self.store._frame(self.now, table, matching)

    def _stage(self, table: str, rows: DataFrame, columns: tuple[str, ...] | None = None) -> str:
        folder = f"data/{table}-{uuid.uuid4().hex}"
        target = self.store.spark.createDataFrame([], self.store.tables[table])
        writer = rows.select(*(rows[f.name].cast(f.dataType).alias(f.name) for f in target.schema if columns is None or f.name in columns)).write
        if table in BY_ATTEMPT:
            writer = writer.partitionBy("attempt_id")
        writer.parquet(f"{self.store.root}/{folder}")
        return folder

    def append(self, table: str, rows: DataFrame) -> None:
        """Rows to add. Of a table that is merged by key: the rows that hold for their keys from now on."""
        self.now["tables"][table] = [*self.now["tables"].get(table, []), {"rows": self._stage(table, rows), "level": 0}]
        self._settle(table)

    def exchange(self, table: str, gone: DataFrame, rows: DataFrame) -> None:
        """Keys to take away and rows to add, in one segment of a table that is merged by key."""
        keys = MERGED[table]
        self.now["tables"][table] = [*self.now["tables"].get(table, []), {"gone": self._stage(table, gone.select(*keys), keys), "rows": self._stage(table, rows), "level": 0}]
        self._settle(table)

    def _settle(self, table: str) -> None:
        """Make TIER last segments of one level one of the next, as long as there are so many."""
        segments, keys = self.now["tables"][table], MERGED.get(table)
        while len(segments) >= TIER and len({s["level"] for s in segments[-TIER:]}) == 1:
            some, rest = segments[-TIER:], segments[:-TIER]
            whole = self.store._merged(table, some)
            joined = {"rows": self._stage(table, whole.where("NOT gone")), "level": some[0]["level"] + 1}
            if keys and rest and any(s.get("gone") for s in some):
                joined["gone"] = self._stage(table, whole.where("gone"), keys)
            segments = [*rest, joined]
        self.now["tables"][table] = segments

    def replace(self, table: str, rows: DataFrame) -> None:
        """The next state of a table; the folders that the rows are read from stay."""
        self.now["tables"][table] = [{"rows": self._stage(table, rows), "level": 0}]

    def compare_and_set(self, key: str, expected: Any, value: Any) -> None:
        if self.now["state"].get(key) != expected:
            raise CommitConflict(f"{key} is {self.now['state'].get(key)!r}, not {expected!r}")
        self.now["state"][key] = value

    def commit(self) -> int:
        self.store._publish(self.base + 1, self.now)
        return self.base + 1
