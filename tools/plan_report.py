"""Write PLANS.md: physical plan shape of the headline queries.

For each query: the operator tree of ``explain("formatted")`` and, per scan,
exchange and broadcast, the lines that matter at scale (ReadSchema,
PushedFilters, partitioning).  Long parse expressions are left out.

Usage: python tools/plan_report.py [sf_dir] [out_file]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wakeline.plans.queries import QUERIES  # noqa: E402
from wakeline.session import local_session  # noqa: E402

SHOWN = ["ais_positions_raw", "ais_valid_vessels", "ais_positions_clean", "ais_delta_t", "ais_delta_histogram"]
KEEP = ("ReadSchema", "PushedFilters", "Arguments: hashpartitioning", "Arguments: rangepartitioning",
        "Arguments: RoundRobinPartitioning", "Join type", "Left keys", "Right keys")


def summarize(plan: str) -> str:
    tree, details = plan.split("\n\n\n", 1) if "\n\n\n" in plan else (plan, "")
    out = [tree.strip(), ""]
    for block in details.split("\n\n"):
        lines = block.strip().split("\n")
        if not lines or not lines[0].startswith("("):
            continue
        head = lines[0]
        keep = [ln for ln in lines[1:] if ln.startswith(KEEP)]
        if keep and any(k in head for k in ("Scan", "Exchange", "Join")):
            out.append(head)
            out += ["    " + re.sub(r"#\d+L?", "", ln)[:220] for ln in keep]
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session(8)
    parts = ["# Physical plans of the headline queries",
             "",
             f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on; plans before AQE's",
             "runtime changes, which at small sizes turn shuffled joins into broadcasts).",
             "Stage tables written while building a query (raw Parquet, key checkpoints) appear as scans.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        parts += [f"## {name}", "", "```", summarize(buf.getvalue()), "```", ""]
    with open(out_file, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
