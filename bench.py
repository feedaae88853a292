"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected). Then the daily batch runs as stages that
exchange written tables (collect -> features -> train -> predict). A failing
query is reported under ``errors`` instead of stopping the run. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # ingest / landing
    "s3_row_json_landing", "a1_pivot_wide", "i3_u1_upsert", "s4_columnar_json_landing",
    # feature step (flagship)
    "features_train", "features_production",
    # profiling
    "a7_scalar_profile", "a8_describe", "a11_iqr_outliers", "a14_f13_target_correlations",
    "a19_kernel_density", "a20_qq_points", "q4_forward_fill",
    # evaluation / serving
    "d1_baseline_predictions", "a24_regression_metrics", "m6_promotion_decisions",
    "m8_j2_j3_forecast_latest", "j6_f16_nearest_hour_lookup",
]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(times: dict, errors: dict, name: str, fn):
    t = time.perf_counter()
    try:
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out
    except Exception as e:  # keep measuring the rest; report the failure
        times[name] = None
        errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        return None


def stages(spark, sf_dir: str, times: dict, errors: dict) -> None:
    """The daily batch as stages that exchange written tables (the
    reference's collect / features / train / predict), at this SF."""
    import uuid
    from seriesforge.plans import train as TR
    from seriesforge.plans.pipeline import Pipeline
    from seriesforge.session import checkpoint_dir
    from seriesforge.sources import tables as T
    p = Pipeline(f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}",
                 wide_values=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                 target="1-urgent", exog_variables=T.WEATHER_COLUMNS, default_start="1992-01-01")
    timed(times, errors, "stage_collect",
          lambda: p.collect(spark, T.row_payloads(spark, sf_dir), T.columnar_payloads(spark, sf_dir)))
    timed(times, errors, "stage_features", lambda: p.features(spark))
    cfg = TR.TrainConfig(horizons=list(range(1, 8)), profile="smoke", selection="linear_shap")
    if timed(times, errors, "stage_train_smoke_21_fits", lambda: p.train(spark, cfg)) is not None:
        timed(times, errors, "stage_predict_7_horizons", lambda: p.predict(spark))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with_stages = os.environ.get("BENCH_TRAIN", "1") == "1"
    from seriesforge.session import checkpoint_dir, get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, "seriesforge-bench",
                      {"spark.driver.memory": "24g"})
    checkpoint_dir(spark)  # the configured shared folder; a local one only when none is named
    from seriesforge.plans.catalog import QUERIES

    # JVM warm-up on the smoke data (different files: no result or cache reuse)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            try:
                run(QUERIES[name](spark, warm_dir))
            except Exception:
                pass
    times, errors = {}, {}
    for name in HEADLINE:
        timed(times, errors, name, lambda name=name: run(QUERIES[name](spark, sf_dir)))
    if with_stages:
        stages(spark, sf_dir, times, errors)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_headline_seconds", "value": round(sum(v for v in times.values() if v), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
