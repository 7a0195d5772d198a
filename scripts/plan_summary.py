"""Physical-plan summary of every registered batch query → PLANS.md.

For each query: shuffles (Exchange), broadcasts, window and generate nodes,
and whether filters and column pruning reached the parquet scans.

usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyflow.plans.catalog import QUERIES  # noqa: E402
from keyflow.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    exchanges = [l for l in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", l)]
    keys = sorted({re.sub(r"#\d+L?", "", m.group(1)) for l in exchanges
                   for m in [re.search(r"hashpartitioning\(([^)]*?), \d+\)", l)] if m})
    scans = [l for l in lines if "FileScan parquet" in l]
    pushed = sum(1 for l in scans if re.search(r"PushedFilters: \[[^\]]+\]", l))
    cols = [len(re.search(r"ReadSchema: struct<(.*)>", l).group(1).split(",")) for l in scans
            if re.search(r"ReadSchema: struct<(.*)>", l)]
    return {
        "shuffles": len(exchanges),
        "shuffle_keys": "; ".join(keys) or "-",
        "broadcasts": sum(1 for l in lines if "BroadcastExchange" in l),
        "windows": sum(1 for l in lines if re.search(r"\bWindow \[", l)),
        "scans": len(scans),
        "scans_with_pushed_filters": pushed,
        "max_scan_columns": max(cols) if cols else 0,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("# Physical plans (initial AQE plans, `explain()`), sf:", sf_dir.rsplit("/", 1)[-1])
    print()
    print("| query | shuffles | shuffle keys | broadcasts | window ops | scans (with pushed filters) | max columns read |")
    print("|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['shuffle_keys']} | {s['broadcasts']} | {s['windows']} | "
              f"{s['scans']} ({s['scans_with_pushed_filters']}) | {s['max_scan_columns']} |")
    spark.stop()


if __name__ == "__main__":
    main()
