"""A failed task is retried and the stored views are still whole."""

import json
import os
import subprocess
import sys
import tempfile

from riverwatch.operators import analytics as A
from riverwatch.operators.classify import classify_risk
from riverwatch.sources.readings import readings

from samples import SF001

HERE = os.path.dirname(os.path.abspath(__file__))


def test_batch_survives_task_failure(spark):
    out = tempfile.mkdtemp(prefix="rw-flaky-")
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "scripts", "flaky_batch.py"),
         os.path.dirname(HERE), SF001, out],
        capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    expected = {r.flood_risk_level: r["count"]
                for r in A.risk_distribution(classify_risk(readings(spark, SF001))).collect()}
    assert got == expected
    failures = os.listdir(os.path.join(out, "failures"))
    assert failures, "no task failure was injected"
