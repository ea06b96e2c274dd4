"""With one vessel holding a third of the rows, no task of the skew-safe operators
reads a hot-vessel-sized share (largest task per shuffle stage, from the event log)."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_largest_task_share():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "/root/testdata/sf0.01"],
                         capture_output=True, text=True, timeout=900)
    m = re.search(r"SKEW (.*)", out.stdout)
    assert m, out.stdout[-2000:] + out.stderr[-2000:]
    share = {k: float(v) for k, v in (x.split("=") for x in m.group(1).split())}
    assert share["hot"] > 0.3
    assert share["plain_window"] > share["hot"]  # the plain per-vessel window puts the hot vessel in one task
    for ours in ("skew_safe", "clean_and_gaps", "busy_hour"):
        assert share[ours] < share["hot"] / 2, (ours, out.stdout[-3000:])
