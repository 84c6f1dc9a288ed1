"""Time the headline operators at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``layer:*`` entries build one table of the pipeline each (written to the shared folder), in order from
raw views to the allocation; the other entries run a query over the finished layers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from retailpot.plans.lake import lake
from retailpot.plans.queries import QUERIES
from retailpot.session import build_session

LAYERS = ("outlets coordinates tx_checked transactions seasonality calendar days sales poi gravity catchment clusters spatial cooler "
          "master baseline blend final limits greedy spread rebalanced adjusted allocation srv_outlets srv_allocations").split()
HEADLINE = ("dq_duplicate dq_run_checks iqr_outlier_flag blackout_months monthly_agg sales_features poi_radius_counts gravity_composite "
            "competitor_counts dbscan cluster_stats pois_near_outlet point_in_polygon round_floats baseline_potential prediction_distribution "
            "roi_rank_tiers distributor_rebalance dashboard_stats rule_briefing feature_summary").split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                               "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine
    lk, times = lake(spark, sf), {}
    for name in LAYERS:
        t = time.perf_counter()
        lk[name]
        times[f"layer:{name}"] = round(time.perf_counter() - t, 3)
    for name in sys.argv[1:] or HEADLINE:
        t = time.perf_counter()
        QUERIES[name](lk).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
