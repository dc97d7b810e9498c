"""Benchmark: run the headline queries and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). ``value`` is the sum of the query times; the
ads view that most queries share is built once and timed as ``ads_view``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_history",
    "target_mean_family",
    "price_var_family",
    "leak_safe_target_stats",
    "group_cumcount",
    "label_encode",
    "box_stats",
    "value_positions",
    "tfidf_sublinear",
    "text_union",
    "dictionary_apply",
    "colour_stats",
    "seed_search",
    "gbt_fit_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]

    from tessera.plans import QUERIES, registry
    from tessera.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    t0 = time.time()
    registry.ads(spark, sf_dir)
    times["ads_view"] = round(time.time() - t0, 3)
    names = only or [q for q in HEADLINE if q in QUERIES]
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
