"""The code bundle: reproducible, importable, shipped to workers that have no repository on their path."""

import os
import shutil
import subprocess
import sys
from pathlib import Path
from zipfile import ZipFile

import pytest

from revisio.plans import bundle

ROOT = Path(bundle.__file__).parents[2]


def elsewhere(folder, code, *, path="", timeout=300):
    """Run code in another folder, with nothing on PYTHONPATH but what is said."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"} | ({"PYTHONPATH": path} if path else {})
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=timeout, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_the_same_tree_gives_the_same_archive(tmp_path):
    first = bundle.build()
    shutil.copytree(bundle.PACKAGE, tmp_path / "revisio", ignore=shutil.ignore_patterns("__pycache__"))
    for p in (tmp_path / "revisio").rglob("*.py"):
        os.utime(p, (1, 1))
    (tmp_path / "revisio" / "notes.txt").write_text("no source")
    assert bundle.build() == first == bundle.build(tmp_path / "revisio")
    (tmp_path / "revisio" / "schema.py").write_text("X = 1\n")
    assert bundle.build(tmp_path / "revisio").sha256 != first.sha256


def test_the_archive_holds_all_sources_and_imports(tmp_path):
    (tmp_path / "code.zip").write_bytes(bundle.build().content)
    names = ZipFile(tmp_path / "code.zip").namelist()
    assert names == sorted(f"revisio/{p.relative_to(bundle.PACKAGE).as_posix()}" for p in bundle.PACKAGE.rglob("*.py"))
    out = elsewhere(tmp_path, "from revisio.plans import bundle, pipeline, registry; print(bundle.digest_here())", path=str(tmp_path / "code.zip"))
    assert out.strip() == bundle.build().sha256


def test_workers_without_the_repository_run_the_shipped_code(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # the driver's path alone
from pyspark.sql import SparkSession
from revisio.plans import bundle
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
try:
    bundle.on_workers(spark).collect()
    raise SystemExit("workers have the repository already")
except Exception as error:
    assert "revisio" in str(error), error
shipped = bundle.check(spark)
assert [r.sha256 for r in bundle.on_workers(spark, 4).collect()] == [shipped.sha256]
assert bundle.ship(spark) is shipped
"""
    elsewhere(tmp_path, code)
    (kept,) = (tmp_path / "shared" / "artifacts").glob("*.zip")
    assert kept.read_bytes() == bundle.build().content


def test_other_code_on_workers_is_refused(spark, monkeypatch):
    other = bundle.Bundle(b"", "0" * 64)
    monkeypatch.setattr(bundle, "ship", lambda _: other)
    with pytest.raises(RuntimeError, match="other code"):
        bundle.check(spark)
