"""Print the plan shape of every registered query of ``plans.queries`` (exchanges, broadcasts,
windows, generators, scalar subqueries, Python nodes, sort-based aggregates)
as a markdown table; with ``--full DIR`` also write each physical plan.

Usage: python tools/plans.py [sf_dir] [--full DIR]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorflow.plans.queries import QUERIES  # noqa: E402
from sensorflow.session import get_session  # noqa: E402

COUNTS = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "windows": r"\bWindow \[",
    "group limits": r"WindowGroupLimit .*Partial",
    "generators": r"\bGenerate ",
    "subqueries": r"Subquery subquery#\d+",
    "sort aggs": r"SortAggregate",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def main() -> None:
    args = sys.argv[1:]
    full = None
    if "--full" in args:
        i = args.index("--full")
        full = args[i + 1]
        args = args[:i] + args[i + 2:]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | " + " | ".join(COUNTS) + " |")
    print("|---|" + "---|" * len(COUNTS))
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        cells = []
        for key, pat in COUNTS.items():
            found = re.findall(pat, plan)
            cells.append(str(len(set(found)) if key == "subqueries" else len(found)))
        print(f"| {name} | " + " | ".join(cells) + " |")
        if full:
            os.makedirs(full, exist_ok=True)
            with open(os.path.join(full, f"{name}.txt"), "w") as f:
                f.write(plan)
    spark.stop()


if __name__ == "__main__":
    main()
