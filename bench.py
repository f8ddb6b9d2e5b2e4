"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stallbook.plans import registry  # noqa: E402
from stallbook.session import local_session  # noqa: E402

HEADLINES = [
    "late_deliveries", "unmatched_not_exists", "monthly_revenue", "category_scores", "seller_ranks",
    "running_spend", "top_products", "churned_customers", "top_categories", "monthly_top_category",
    "cut_line_band", "repeat_share", "delay_vs_score", "nearest_cosine", "clean_orders", "clean_order_reviews",
    "unique_key_report", "reference_report", "key_uniqueness", "cast_validity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cores, shuffle_partitions=int(cores))
    queries = registry.queries()

    def seconds(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first run of each query compiles its code; the second is the one timed.
    timings = {}
    for name in HEADLINES:
        seconds(name)
        timings[name] = round(seconds(name), 3)
    print(json.dumps({"metric": "total query time", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
