"""bench.py prints exactly one JSON line with the agreed keys (run on sf0.001, two queries)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "flagship_cost_threshold",
                          "e6_cost_curve_by_model"], capture_output=True, text=True, env=env, timeout=900, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"flagship_cost_threshold",
                                                                              "e6_cost_curve_by_model"}
    assert d["value"] > 0
