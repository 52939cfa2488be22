"""Time the headline reports and print one JSON line.

Reads the tables under ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.  Every query runs
once to warm up and then three times; the median counts.  Results go to Spark's noop
sink, so whole tables are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINES = (
    "r03_top_countries",
    "r05_r08_sot_levels",
    "r09_r12_ots_levels",
    "r15_brand_category_combined",
    "r16_brand_combined",
    "r19_preferred_combined",
    "r20_ots_by_centre",
    "r23_country_combined",
    "r26_vendor_combined",
    "r27_stocked_vs_shipped",
    "r28_brand_delays",
    "r31_vendor_week_percent",
    "r48_dashboard",
    "r50_failure_classes",
    "r54_brand_impact_ytd",
    "r62_vendor_impact_ytd",
    "r65_reason_spread",
    "r66_sub_reason_spread",
    "r67_choice_base",
    "r68_first_choice",
    "r77_vendor_lateness_ytd",
    "r79_brand_series",
)


def main(names: list[str]) -> None:
    from dockside.catalog import QUERIES
    from dockside.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names or HEADLINES:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "report_seconds_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
