"""Time the headline queries on the folder in $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from plumbline.plans.registry import QUERIES
from plumbline.session import build

HEADLINE = (
    "pricing_summary", "kpi_verdict", "segment_quantiles", "rule_counts_unpivot", "service_cells", "stage_decomposition", "negative_signature", "segment_profile", "later_copies", "column_profile",
    "dedup_all_columns", "late_rate_definitions", "stage_by_dimension", "order_outcome_table", "timeline_union", "crosstab_margins", "latest_attempt", "top_share",
)


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", "8"))
    spark = build(f"local[{cpus}]", cpus, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    times: dict[str, float] = {}
    for n in names:
        best = None
        for _ in range(2):  # the first run also compiles
            begun = time.perf_counter()
            QUERIES[n](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begun
            best = took if best is None else min(best, took)
        times[n] = round(best, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
