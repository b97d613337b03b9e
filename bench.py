"""Times every registered query once and prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores. Each result is
computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.registry import QUERIES
from tidemark.session import local_session
from tidemark.sources.tables import given


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), "16g")
    rows = {
        name: given(spark, folder, name).count()
        for name in ("customer", "supplier", "part", "orders", "lineitem")
    }
    QUERIES["order_count"](spark, folder).collect()  # so that start-up is not timed
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "all_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
                "input_rows": rows,
                "line_items_per_sec": {
                    name: round(rows["lineitem"] / seconds[name])
                    for name in ("customer_orders_summary", "monthly_sales_trend", "top_products")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
