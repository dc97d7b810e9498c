"""Summarise the executed (adaptive, final) plans of registered queries:
shuffles, join strategies, windows, and each Parquet scan's pushed filters
and read schema.

    python tools/plans.py /root/testdata/sf0.01 user_history tfidf_sublinear ...
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def summarise(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run once so AQE settles the plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    head = (f"hash-exchanges={plan.count('Exchange hashpartitioning')} "
            f"range-exchanges={plan.count('rangepartitioning')} "
            f"sort-merge-joins={plan.count('SortMergeJoin')} "
            f"broadcast-joins={plan.count('BroadcastHashJoin')} "
            f"windows={plan.count('Window [')}")
    scans = set()
    for line in plan.splitlines():
        if "FileScan" not in line and "Scan parquet" not in line:
            continue
        f = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        s = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        scans.add(f"  scan filters={f.group(1) if f else '[]'} schema={s.group(1) if s else '?'}")
    return "\n".join([head, *sorted(scans)])


def main() -> None:
    sf_dir = sys.argv[1]
    from tessera.plans import QUERIES
    from tessera.session import build_session

    spark = build_session("local[8]")
    for name in sys.argv[2:]:
        print(f"== {name}\n{summarise(QUERIES[name](spark, sf_dir))}")


if __name__ == "__main__":
    main()
