"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark import catalog
from tidemark.session import local_session

HEADLINE = (
    "panel_from_facts", "panel_nation_segment", "resample_last", "time_interpolate", "make_target_features",
    "make_target_features_weekly", "corr_with_target", "corr_matrix", "binned_mutual_information", "vif_prune",
    "elasticnet_rank", "forecast_metrics", "select_ensemble", "recursive_forecast", "ets_forecast", "theta_forecast",
    "ar_search_forecast", "driver_backtest_weights", "driver_anomalies", "model_ols", "model_elasticnet", "model_rf",
    "run_feature_selection", "run_model_selection", "run_future_forecast",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="bench")
    plans = catalog.spark_queries()
    plans["panel_from_facts"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
