"""bench.py runs end to end and prints one JSON line (sf0.001, one repeat)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_REPEAT="1", BENCH_CPUS="4")
    proc = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], cwd=str(tmp_path), env=env,
                          capture_output=True, text=True, timeout=900)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == set(entry.queries())
    assert out["value"] == pytest.approx(sum(out["queries"].values()), abs=1e-3)


def test_workflow_examples_run(tmp_path):
    proc = subprocess.run([sys.executable, os.path.join(REPO, "examples", "workflows.py")], cwd=str(tmp_path),
                          capture_output=True, text=True, timeout=900)
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert "png_count" in proc.stdout and "labels/L3.json" in proc.stdout
