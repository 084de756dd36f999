"""Workers that cannot import the package run all operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUN = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__
from sievemill import get_session
spark = get_session("elsewhere", master="local[4]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"})
spark.sparkContext.setLogLevel("ERROR")
for name, query in __spark_entry__.queries().items():
    if name == "pipeline" or name.startswith("op"):
        try:
            print(name, query(spark, sys.argv[2]).count(), flush=True)
        except Exception as e:
            print(name, "FAILED", str(e)[-400:], flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_all_run_where_the_package_is_not_installed(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN, ROOT, SF_DIR], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = done.stdout.split("\n")
    assert sum(line.startswith(("op", "pipeline")) for line in lines) == 14 and "FAILED" not in done.stdout, done.stdout
