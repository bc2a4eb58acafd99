"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS the number
of local threads, BENCH_QUERIES a list of names in place of the default ones.
Each query is planned and run to its end once, after a few that only warm the
JVM up and are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """
medallion_daily_summary silver_clean silver_deduplicate daily_summary
trends rolling_rows moving_average_full daily_trend rank_readings rank_orders quartiles
key_overview key_comparison category_distribution event_report data_health hourly_pattern anomalies transitions
global_dashboard global_kpis completeness check_summary key_mart global_mart event_episodes correlations
check_ranges_gaps_allowed check_relationships_where check_unique_combination
pivot unpivot union_relations date_spine surrogate_key url_parts
insert_new upsert compacted stream_raw_to_silver stream_daily_summary
""".split()


def main() -> None:
    from catalog import QUERIES
    from gaugeflow.runtime import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    partitions = int(cpus) if cpus.isdigit() else 8
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = session("bench", f"local[{cpus}]", partitions, spark__driver__memory="16g", spark__checkpoint__dir=shared)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("daily_summary", "key_mart", "medallion_daily_summary"):
        run(name)
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
