"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import catalog
from tidemark.session import build_session, intermediates

HEADLINE = (
    "j06_feature_vintage", "j05_asof_latest", "j08_label_after_decision", "a03_interpolated_quantiles", "a13_fallback_levels",
    "m01_intraday_state", "m04_climatology", "m07_daily_ensemble", "m08_ensemble_features", "m10_bucket_probabilities",
    "m11_station_bias", "m14_convex_blend", "e01_forecast_skill", "e02_bucket_skill", "e12_robustness", "x02_next_bar_fills",
    "b01_level_history", "w08_canonical_rows", "w10_sequence_health",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # One small run first, so that the first query does not pay for starting the engine.
    catalog.QUERIES["j04_key_membership"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        with intermediates(spark):
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
