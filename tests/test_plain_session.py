"""Queries with Python functions run in a session without our settings, started from another folder."""

import os
import subprocess
import sys

JOB = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for name in {names!r}:
    print("ROWS", name, len(e.queries()[name](spark, {folder!r}).collect()))
"""
NAMES = ["word_documents", "word_run_summary", "document_images", "headline_summary", "scan_sql_files"]


def test_plain_session_elsewhere(sf_dir, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    job = JOB.format(repo=repo, names=NAMES, folder=sf_dir)
    done = subprocess.run([sys.executable, "-c", job], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    counts = [line.split() for line in done.stdout.splitlines() if line.startswith("ROWS")]
    assert [c[1] for c in counts] == NAMES and all(int(c[2]) > 0 for c in counts), done.stderr[-2000:]
