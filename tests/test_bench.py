"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_QUERIES="coverage,latest_wins_events",
               BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["sf"] == 0.001
    assert set(d["queries"]) == {"coverage", "latest_wins_events"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
