"""Benchmark: the ETL load once, then every API query against the loaded tables.

Prints one JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline.operators.sinks import write_loaded  # noqa: E402
from meterline.plans import anomalies, client, overview, profitability, stats, tips  # noqa: E402
from meterline.plans.pipeline import load  # noqa: E402
from meterline.plans.tables import fixture_inputs, from_store  # noqa: E402
from meterline.operators.geo import zone_shapes  # noqa: E402
from meterline.session import build_session, shared_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

API_QUERIES = {
    "overview_kpis": overview.overview_kpis,
    "overview_trips_over_time": lambda t: overview.trips_over_time(t, "day"),
    "overview_top_zones": lambda t: overview.top_zones(t, 20),
    "profitability_top_zones": lambda t: profitability.top_profitable_zones(t, 20),
    "profitability_by_borough": profitability.by_borough,
    "profitability_by_hour": profitability.by_hour,
    "tips_by_borough": tips.tips_by_borough,
    "tips_by_hour": tips.tips_by_hour,
    "tips_payment_comparison": tips.payment_comparison,
    "anomalies_summary": anomalies.summary,
    "anomalies_by_type": anomalies.by_type,
    "anomalies_list": lambda t: anomalies.anomaly_list(t, 50, 0)[0],
    "hourly_stats": stats.hourly_stats,
    "zone_stats": stats.zone_stats,
    "client_profit_ranking": client.profit_ranking,
    "client_tip_insight": client.tip_insight,
}


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=CPUS * 2, app_name="meterline-bench")
    # outputs go under the cluster's shared folder (spark.checkpoint.dir); a private one only when unset
    root = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    times: dict[str, float] = {}

    # JVM warm-up (class loading, JIT of the generated code) on the smallest fixture, reported separately
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    cold = None
    if os.path.isdir(warm_dir):
        t0 = time.time()
        w_raw, w_zones, w_features = fixture_inputs(spark, warm_dir)
        write_loaded(load(w_raw, w_zones), w_zones, f"{root}-warmup", zone_shapes(w_features))
        cold = round(time.time() - t0, 3)

    raw, zones, features = fixture_inputs(spark, SF_DIR)
    t0 = time.time()
    loaded = load(raw, zones)
    etl_steps: dict = {}
    write_loaded(loaded, zones, root, zone_shapes(features), timings=etl_steps)
    times["etl_load"] = round(time.time() - t0, 3)
    raw_rows = spark.read.parquet(os.path.join(root, "load_summary")).first()["total_raw_rows"]

    tables = from_store(spark, root)
    for name, fn in API_QUERIES.items():
        t0 = time.time()
        fn(tables).collect()
        times[name] = round(time.time() - t0, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "etl_rows_per_sec": round(raw_rows / times["etl_load"], 1), "raw_rows": raw_rows, "cpus": CPUS,
        "warmup_sec_smallest_sf": cold, "etl_steps": etl_steps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
