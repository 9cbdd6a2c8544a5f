"""The operators where workers have no copy of the library."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
PROGRAM = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", "checkpoints")
    .getOrCreate()
)
from __spark_entry__ import queries
found = queries()
for name in (
    "op1_language_id", "op6_substring_dedup", "op7_token_counts", "op8_simhash_near_dedup",
    "op9_quality_rules", "op11_minhash_near_dedup", "op12_lexical_search",
    "op13_embedding_whitening",
):
    assert found[name](spark, "/root/testdata/sf0.001").count() > 0, name
    print("ran", name)
"""


def test_operators_run_on_workers_without_the_library(tmp_path):
    program = tmp_path / "driver.py"
    program.write_text(PROGRAM.format(repo=str(REPO)))
    done = subprocess.run(
        [sys.executable, "driver.py"], cwd=tmp_path, capture_output=True, text=True, timeout=900
    )
    assert done.stdout.count("ran op") == 8, done.stderr[-3000:]
