"""Times the headline queries and prints one JSON line.

Each query runs to the end (every row and column is produced, nothing is kept);
the figure is the median of `BENCH_REPEATS` runs (1 by default) after a warm-up, planning and stored
intermediate steps included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stormgrid.catalog import REGISTRY  # noqa: E402
from stormgrid.session import build_session  # noqa: E402

HEADLINE = [
    "daily_actuals", "outage_clean_filter", "device_location_join", "outage_grain_agg", "outage_ads", "keyword_flags",
    "outage_geo", "restoration_diagnostic", "storm_actual_vs_predicted", "not_yet_predicted", "daily_clue_counts",
    "rank_subsequent", "priority_by_customers", "priority_by_distance", "trailing_hour_counts", "ffill_coordinates", "ffill_all",
    "nearest_marker", "nearest_depot", "outage_weather_join", "weather_day_rollup", "marker_pivot", "latest_forecast_dedup",
    "upsert_latest", "zscore", "stream_daily_counts", "live_outage_dataset",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stormgrid-bench-"))
    seconds = {}
    for name in names:
        query = REGISTRY[name].run
        run(query, spark, folder)
        seconds[name] = round(statistics.median(run(query, spark, folder) for _ in range(repeats)), 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
