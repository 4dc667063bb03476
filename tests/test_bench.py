"""The benchmark runs to its end and prints one JSON line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_runs(tmp_path):
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_REPEAT": "1",
           "BENCH_SETTLE": "0"}
    done = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=tmp_path,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    out = json.loads(done.stdout.strip().splitlines()[-1])
    assert out["value"] > 0 and out["unit"] == "sec" and len(out["queries"]) == 17
