"""Queries with Python workers run from any folder."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__
from tastegrid.session import local_session
spark = local_session(cores=2, shuffle_partitions=2, memory="2g")
frame = __spark_entry__.queries()["rc14_nearest_exact"](spark, "/root/testdata/sf0.001")
print("rows", frame.count() > 0)
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows True" in done.stdout, done.stderr[-2000:]
