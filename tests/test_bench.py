"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=900,
        check=True,
    ).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1, out
    report = json.loads(lines[0])
    assert report["unit"] == "sec" and report["sf"] == 0.001
    from bench import TIMED
    from starlens.plans.catalog import QUERIES

    assert set(report["queries"]) == set(TIMED) < set(QUERIES)
    assert abs(report["value"] - sum(report["queries"].values())) < 0.01 * len(TIMED)
    assert abs(report["total_with_star_build"] - report["value"] - report["star_build_sec"]) < 0.01
