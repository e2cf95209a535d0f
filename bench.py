"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

from registry import QUERIES
from shelfweek.session import get_session

HEADLINE = (
    "weekly_sales", "weekly_shipments", "new_goods_activity", "location_detail", "transfer_pivot", "serial_facts", "online_rollup_used",
    "chain_by_source", "title_running_totals", "work_program_rollup", "nearest_in_time", "merged_item_rates", "trailing_forward_rates",
    "inbound_detail_lines",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g", spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["weekly_sales"](spark, root).write.format("noop").mode("overwrite").save()  # warm the virtual machine
    spent = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {spent[name]}", file=sys.stderr)
    spark.stop()
    scale = os.path.basename(root.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent, "sf": scale}))


if __name__ == "__main__":
    main()
