"""Write PLANS.md: the physical plan outline of the headline queries.

Usage: python tools/dump_plans.py [sf_dir]
Keeps the operator tree plus the scan, exchange and join details of
``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from hourcast.plans import catalog as C  # noqa: E402
from hourcast.session import build_session  # noqa: E402

QUERIES = ["hourly_from_events", "cumulative_profile", "union_segments", "preview_first_rows",
           "csv_roundtrip_hourly", "moments_per_segment", "linear_score_join", "metrics_per_segment",
           "score_alerts", "tree_score_segments"]
KEEP = re.compile(r"^(\s*[+:|-]|\(\d+\) (Scan|Exchange|BroadcastHashJoin|SortMergeJoin|HashAggregate|Window)"
                  r"|ReadSchema|PushedFilters|PartitionFilters|Keys|Arguments: hash|Join type|Functions)")


def outline(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = [ln.rstrip() for ln in buf.getvalue().splitlines() if KEEP.search(ln)]
    return "\n".join(ln[:220] for ln in lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` (AQE initial plans; trimmed to the operator",
           "tree, scans, exchanges, joins and aggregates).", ""]
    for name in QUERIES:
        out += [f"## {name}", "", "```", outline(C.REGISTRY[name](spark, sf_dir)), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
