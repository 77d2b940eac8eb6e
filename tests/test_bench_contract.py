"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=1200,
        check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    from growthlens import catalog

    assert set(result["queries"]) == set(catalog.QUERIES)
    assert all(v > 0 for v in result["queries"].values())
