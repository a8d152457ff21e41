"""The package as one reproducible archive, shipped to executors and checked there [J2].

The archive depends on the files alone: members in order of their names, one fixed time and mode,
stored without compression. The same tree gives the same SHA-256 wherever and whenever it is
built. It is written to the shared folder under its digest and added to the application's Python
files, which each executor fetches before its first task, so that executors which join later have
it as well. Whatever starts queries ships first (`shipped`); executors need no
repository on their path.
"""

from __future__ import annotations

import functools
import hashlib
import io
import zipimport
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from zipfile import ZIP_STORED, ZipFile, ZipInfo

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).parent.parent
_TIME, _MODE = (2020, 1, 1, 0, 0, 0), 0o644 << 16


@dataclass(frozen=True)
class Bundle:
    """The archive's bytes and their SHA-256."""

    content: bytes
    sha256: str

    @property
    def name(self) -> str:
        return f"{PACKAGE.name}-{self.sha256[:16]}.zip"


def build(package: Path = PACKAGE) -> Bundle:
    """All Python sources of a package, and nothing else."""
    out = io.BytesIO()
    with ZipFile(out, "w", ZIP_STORED) as archive:
        for name, source in sorted((f"{package.name}/{p.relative_to(package).as_posix()}", p) for p in package.rglob("*.py")):
            member = ZipInfo(name, _TIME)
            member.external_attr = _MODE
            archive.writestr(member, source.read_bytes())
    return Bundle(out.getvalue(), hashlib.sha256(out.getvalue()).hexdigest())


_SHIPPED: dict[str, Bundle] = {}


def ship(spark: SparkSession) -> Bundle:
    """Add the archive to the application's Python files, once."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        from revisio.plans.lineage import shared_dir

        bundle = build()
        path = f"{shared_dir(spark)}/artifacts/{bundle.name}"
        _write(spark, path, bundle.content)
        spark.sparkContext.addPyFile(path)
        _SHIPPED.clear()  # of applications that have ended
        _SHIPPED[application] = bundle
    return _SHIPPED[application]


def _write(spark: SparkSession, path: str, content: bytes) -> None:
    """Write beside and rename, so that no one reads half a file; a file under the digest's name is the same file."""
    jvm = spark.sparkContext._jvm
    target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{spark.sparkContext.applicationId}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        return
    stream = fs.create(aside, True)
    stream.write(content)
    stream.close()
    if not fs.rename(aside, target) and not fs.exists(target):
        raise OSError(f"cannot write {path}")


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, with the archive shipped before it plans anything. Its first argument is the session."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        ship(spark)
        return query(spark, *args, **options)

    return run


def digest_here() -> str:
    """The digest of the code that this process imported: of the archive, or of an archive of the folder."""
    import revisio

    loader = revisio.__loader__
    if isinstance(loader, zipimport.zipimporter):
        return hashlib.sha256(Path(loader.archive).read_bytes()).hexdigest()
    return build(Path(revisio.__file__).parent).sha256


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import socket

    for batch in batches:
        yield pa.RecordBatch.from_pydict({"host": [socket.gethostname()] * batch.num_rows, "sha256": [digest_here()] * batch.num_rows})


def on_workers(spark: SparkSession, tasks: int | None = None) -> DataFrame:
    """(host, sha256, tasks): which code the workers import."""
    n = tasks or spark.sparkContext.defaultParallelism
    return spark.range(n, numPartitions=n).mapInArrow(_digests, "host string, sha256 string").groupBy("host", "sha256").count().withColumnRenamed("count", "tasks")


def check(spark: SparkSession, tasks: int | None = None) -> Bundle:
    """Ship, and raise unless every worker that answers runs exactly this code."""
    bundle = ship(spark)
    others = on_workers(spark, tasks).where(f"sha256 <> '{bundle.sha256}'").collect()
    if others:
        raise RuntimeError(f"workers run other code than {bundle.sha256}: " + ", ".join(f"{r.host} {r.sha256} ({r.tasks} tasks)" for r in others))
    return bundle
