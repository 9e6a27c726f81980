"""Executors have no copy of the package: everything a task needs travels with it."""

import os
import subprocess
import sys

from conftest import ROOT, SMALL

SCRIPT = """
import os, sys
folder, root, sf_dir = sys.argv[1:]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
spark = spark.config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", folder + "/shared").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, root)  # the driver's own path; workers are not told of it
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        print("done", name, flush=True)
"""


def test_workers_without_the_package(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    (tmp_path / "empty").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, str(tmp_path / "run.py"), str(tmp_path), str(ROOT), SMALL]
    ran = subprocess.run(command, cwd=tmp_path / "empty", env=env, capture_output=True, text=True, timeout=1800)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("done op") == 13 and "done pipeline" in ran.stdout
