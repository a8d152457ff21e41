"""Every training-data query from another folder, with nothing of the repository on the workers' path."""

from tests.test_bundle import ROOT, elsewhere


def test_all_queries_run_where_workers_have_no_repository(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # the driver's path alone
from pyspark.sql import SparkSession
import __spark_entry__
from revisio.llm import queries
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
found = __spark_entry__.queries()
assert len(queries.QUERIES) == 13
for name in queries.QUERIES:
    print(name, found[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""
    out = dict(line.rsplit(" ", 1) for line in elsewhere(tmp_path, code, timeout=1200).splitlines() if line.startswith("op"))
    assert len(out) == 13 and int(out["op11_ngram_trie"]) == int(out["op13_merkle_manifest"]) == 200 and int(out["op12_ball_tree_clusters"]) == 500
