"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
A warm-up pass runs every query once (JVM JIT, file listing), then
``$BENCH_REPEAT`` (default 2) timed passes run; the best time per query is
recorded. Results are
fully materialised with the ``noop`` sink, so nothing is collected to the
driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessel.plans.catalog import QUERIES  # noqa: E402
from tessel.session import build_session  # noqa: E402

HEADLINE = [
    "fact_quarterly", "fact_annual", "fact_metric",
    "series_quarterly_position", "series_quarterly_period", "series_full_outer",
    "series_long", "typed_union", "split_typed", "type_counts", "series_bearing",
    "metric_catalog", "legacy_wide", "freq_full_outer",
    "documents_for_symbols", "json_parse_props", "quarantine", "quality_report_quarterly",
    "new_symbols", "zip_join", "symbol_directory", "snapshot_partition",
    "raw_write_read", "stream_ingest", "weekly_fact_quarterly",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                          extra={"spark.driver.memory": "16g"})
    for name in only:
        run(spark, name, sf_dir)
    best = {name: float("inf") for name in only}
    for _ in range(repeat):
        for name in only:
            best[name] = min(best[name], run(spark, name, sf_dir))
    times = {name: round(t, 3) for name, t in best.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_warm_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
