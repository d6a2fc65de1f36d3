"""Summarise the physical plan of each registered query: exchanges, joins, and what to look into.

    python scripts/plans.py [--sf DIR] [NAME ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.catalog import REGISTRY  # noqa: E402
from starloom.session import local_session  # noqa: E402

COUNTED = (
    "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "Exchange hashpartitioning",
    "Exchange rangepartitioning", "Exchange SinglePartition", "Window ", "WindowGroupLimit",
)
SUSPECT = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--no-broadcast", action="store_true", help="plan as if no side were small")
    parser.add_argument("--full", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session("plans")
    if args.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in args.names or REGISTRY:
        text = plan_text(REGISTRY[name].build(spark, args.sf))
        counts = {c.strip(): len(re.findall(re.escape(c), text)) for c in COUNTED}
        found = [s for s in SUSPECT if s in text]
        print(name, {k: v for k, v in counts.items() if v}, *(["LOOK", found] if found else []))
        if args.full:
            print(text)


if __name__ == "__main__":
    main()
