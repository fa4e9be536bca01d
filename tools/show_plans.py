"""Print the final (post-AQE) physical plan of registered queries, compactly.

Usage: python tools/show_plans.py [sf_dir] key [key ...]
The final plan only, without expression ids.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tollflow.registry import QUERIES  # noqa: E402
from tollflow.session import local_session  # noqa: E402

_IDS = re.compile(r"#\d+L?")


def compact(plan: str, width: int = 150) -> str:
    out, skip = [], None
    final = plan.split("== Initial Plan ==")[0]
    for line in final.splitlines():
        body = line.lstrip(" :+-")
        depth = len(line) - len(body)
        if skip is not None:
            if depth > skip:
                continue
            skip = None
        if not body or body.startswith(("== Final Plan ==", "AdaptiveSparkPlan")):
            continue
        if "InMemoryTableScan" in body or "InMemoryRelation" in body:
            skip = depth
        text = _IDS.sub("", line)
        text = re.sub(r"\[plan_id=\d+\]", "", text)
        out.append(text[:width])
    return "\n".join(out)


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    for k in args:
        df = QUERIES[k](spark, sf_dir)
        df.collect()          # run this very plan so AQE prints its final form
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {k}\n\n```\n{compact(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
