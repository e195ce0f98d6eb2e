"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, of which the fastest counts (default 2)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from acceptance.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "fraud_report_passport",
    "fraud_report_contract",
    "fraud_report_all",
    "txn_enriched",
    "scd2_apply_snapshot",
    "scd2_apply_incremental",
    "snapshot_changed",
    "dim_first_seen",
    "validate_history",
    "watermark_extract",
    "watermark_advance",
    "fact_transactions_load",
    "src_delimited",
    "src_workbook",
    "cards_load",
    "terminals_load",
    "report_stored",
    "feed_stream",
]


def seconds(spark, name: str, folder: str) -> float:
    """From building the query to the last row reaching a sink that discards it."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        spark = build_session(
            "bench",
            f"local[{cpus}]",
            **{
                "spark.sql.shuffle.partitions": cpus,
                "spark.ui.enabled": "false",
                "spark.driver.memory": "12g",
                "spark.checkpoint.dir": shared,
            },
        )
        spark.sparkContext.setLogLevel("ERROR")
        times = {n: round(min(seconds(spark, n, folder) for _ in range(runs)), 3) for n in names}
        spark.stop()
    found = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else folder,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
