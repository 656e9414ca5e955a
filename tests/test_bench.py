"""bench.py prints one JSON line with a time per headline query."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMOKE


def test_bench_smoke():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMOKE, BENCH_CPUS="4", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result) == {"metric", "value", "unit", "queries", "sf"}
    assert result["queries"] and all(v > 0 for v in result["queries"].values())
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-3
