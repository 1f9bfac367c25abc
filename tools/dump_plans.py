"""Write the final (adaptive) physical plans of the headline queries to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rosterline.plans import registry  # noqa: E402
from rosterline.session import build_session  # noqa: E402

HEADLINE = [
    "facility_summary", "state_summary", "state_overview", "enrich_left", "facility_analytics",
    "staffing_bands", "top_facilities", "daily_trend", "describe_hprd", "provider_dedup",
    "duplicate_rows", "manifest_summary",
]
WIDTH = 170


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    out = [
        "# Physical plans of the headline queries",
        "",
        f"Final adaptive plans after execution on `{sf_dir}` (local[8], 8 shuffle partitions),",
        f"lines cut at {WIDTH} characters. Generated by `tools/dump_plans.py`.",
        "",
    ]
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        df.collect()  # executes this DataFrame's own plan, so AQE's final plan is kept
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln if len(ln) <= WIDTH else ln[: WIDTH - 3] + "..." for ln in plan.splitlines()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
