"""Summarize the physical plan of every batch query (exchanges, joins, scans).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chargepulse.plans.catalog import QUERIES  # noqa: E402
from chargepulse.session import get_session  # noqa: E402
from tools import explain_text  # noqa: E402


def summarize(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    ex = re.findall(r"Arguments: (hashpartitioning|RoundRobinPartitioning|SinglePartition|rangepartitioning)"
                    r"[^\n]*", plan)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    return {
        "exchanges": [e for e in ex],
        "broadcast": nodes.count("BroadcastExchange"),
        "joins": [n for n in nodes if n.endswith("Join")],
        "topn": "TakeOrderedAndProject" in nodes,
        "generate": nodes.count("Generate"),
        "python": any(n in nodes for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")),
        "scans": schemas,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    print("| query | shuffles | broadcast | joins | top-N | parses | python | scan columns |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for k, q in QUERIES.items():
        df = q(spark, sf_dir)
        plan = explain_text(df, "formatted")
        s = summarize(plan)
        shuffles = ", ".join(sorted(set(e for e in s["exchanges"]))) or "-"
        scans = "; ".join(sc[7:-1] for sc in s["scans"])
        print(f"| {k} | {len(s['exchanges'])} ({shuffles}) | {s['broadcast']} | "
              f"{', '.join(s['joins']) or '-'} | {'yes' if s['topn'] else '-'} | {s['generate']} | "
              f"{'YES' if s['python'] else 'no'} | {scans} |")


if __name__ == "__main__":
    main(sys.argv)
