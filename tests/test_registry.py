"""Every registered query against its SQL twin at the smallest scale."""

import math
import os
import pathlib
import shutil
import subprocess
import sys

import duckdb
import pytest

from revisio.plans import lineage, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows_of(rows):
    fix = lambda v: (round(v, 6) if math.isfinite(v) else str(v)) if isinstance(v, float) else v if isinstance(v, (int, str, bool, type(None))) else str(v)
    return sorted((tuple(map(fix, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_twin(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(registry.SQL[name])
    assert sorted(relation.columns) == columns
    assert rows_of(df.select(*columns).collect()) == rows_of(duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.SQL[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 9
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_training_operators(tmp_path):
    """A copy without the subpackage, its tests and the corpus pipeline imports and lists the other queries."""
    root = pathlib.Path(registry.__file__).parents[2]
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": str(tmp_path / "copy")}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.SQL)), "False"]


def test_cuts_are_cleaned(spark):
    registry.QUERIES["alias_components"](spark, SF).count()
    roots = list(lineage._ROOTS)
    assert roots and lineage.clean(spark) >= 1 and not lineage._ROOTS
    assert not any(os.path.exists(r.removeprefix("file://")) for r in roots)
