"""Task retries leave results unchanged (own process: local[4,4] allows retries)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_results_survive_task_retries():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "retry_check.py"), "/root/testdata/sf0.001"],
                         capture_output=True, text=True, timeout=600)
    assert "RETRY-CHECK OK positions=1000 gaps=427" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
