"""The entry point with and without the training-data part, and a query on a session without Arrow."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder, code):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=600,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


def test_entry_works_without_the_training_data_folders(tmp_path):
    left = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests")
    bare = shutil.copytree(REPO, tmp_path / "bare", ignore=left)
    assert (bare / "corpus_pipeline.py").exists() and not (bare / "quillstat" / "llm").exists()
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(len(e.oracle_sql()))"
    names = run(bare, code)
    assert "anova_feature_ranking" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]
    if os.path.isdir(os.path.join(REPO, "quillstat", "llm")):
        assert {"pipeline", "op12_prefix_trie"} <= set(run(REPO, code))


def test_hierarchical_clusters_need_no_arrow():
    code = """
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
rows = e.queries()["hierarchical_clusters"](spark, "/root/testdata/sf0.001").collect()
print("rows", len(rows), sum(r["n"] for r in rows), spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count())
"""
    *_, groups, total, n = run(REPO, code)
    assert int(groups) >= 3 and total == n
