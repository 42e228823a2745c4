"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_REPS": "1",
           "BENCH_QUERIES": "q01,h2o_q1"}
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, cwd=root)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"q01", "h2o_q1"} and d["sf"] == 0.001
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-2
