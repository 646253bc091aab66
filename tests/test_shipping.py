"""The package reaches the Python workers of a driver that was started elsewhere."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from shelfcast.operators import boosting, trees
from shelfcast.session import build_session
spark = build_session(master="local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
rows = spark.range(60).selectExpr("id % 3 as shop_id", "id as item_id", "cast(id % 7 as double) as x", "cast(id % 7 as double) as y")
packed = boosting.pack(rows, rows, rows, ["x"], "y")
fit, found = trees.fit_trees(packed, trees.TreeParams(depth=2, min_child_weight=1, rounds=2))
print("rows", found.count(), fit.rounds)
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240, check=False
    )
    assert "rows 60 2" in done.stdout, done.stderr[-2000:]
