"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed fully (noop sink, nothing collected to the driver); the
reported time per query is the median of ``BENCH_RUNS`` warm runs. The element
index (``dom_index``) is built once and timed as its own entry; queries that use it
read the persisted index, as they would read the written index table on a cluster.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "url_scan", "link_extract", "seen_anti", "frontier", "page_text", "dom_elements", "body_texts",
    "rule_strip", "rule_trim", "preset_union", "preset_target_div", "snapshot_concat",
    "snapshot_accumulate", "converged", "versioned_names", "stream_dedup", "preset_js",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from webloom.plans import queries as Q
    from webloom.session import get_session

    spark = get_session(cpus=cpus, app="webloom-bench")
    n_pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    samples = []
    for i in range(runs):  # build, materialize, and (except the last) drop the index
        Q._DOM_INDEX.clear()
        t0 = time.time()
        dom = Q.dom_index(spark, sf_dir)
        rows["dom_index"] = dom.count()
        samples.append(time.time() - t0)
        if i < runs - 1:
            dom.unpersist(blocking=True)
    timings["dom_index"] = round(statistics.median(samples), 3)

    for name in names:
        q = Q.QUERIES[name]
        samples = []
        for _ in range(runs):
            t = time.time()
            df = q(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        timings[name] = round(statistics.median(samples), 3)
        rows[name] = q(spark, sf_dir).count()

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "pages": n_pages,
        "pages_per_sec_rule_strip": round(n_pages / timings["rule_strip"], 1) if timings.get("rule_strip") else None,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
