"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "x1_read_readings",
    "r1_pivot_metrics",
    "r2_create_grid",
    "b1_build_blocks",
    "n1_fill_nearest",
    "a6_time_gap_frequency",
    "d6_d7_detect_anomalies",
    "c3_pairwise_correlation",
    "m6_add_predictive",
    "b6_event_blocks",
    "m10_rolling_and_derivative",
    "r5_resample_sensor_near",
    "c13_auc_by_block_sensor",
    "q1_prepare",
    "q2_anomaly_report",
    "q3_maintenance_report",
]


def run_stages(spark, sf_dir):
    """Seconds of the chain's stages, each once, from the written output of the one
    before: reading the CSV files (written before the clock starts), pivot, grid to
    filled blocks, anomalies, ranking of the sensors, labels and features, and a
    random forest of 40 trees with its report."""
    from pyspark.sql import functions as F
    from vigil.operators.anomaly import detect_anomalies
    from vigil.operators.blocks import build_blocks
    from vigil.operators.correlation import pairwise_correlation
    from vigil.operators.grid import create_grid, pivot_metrics
    from vigil.operators.nulls import fill_nearest
    from vigil.plans import composite, stand_in as S
    from vigil.plans.catalog import FEATURES
    from vigil.session import cut_lineage, scratch_path
    from vigil.sources.readings import EVENT_METRICS, EVENT_ROLES, READINGS_SCHEMA, read_readings
    raw = scratch_path(spark, "bench-csv")
    S.readings(spark, sf_dir).withColumn("when", F.col("when") * 1000) \
        .select(*READINGS_SCHEMA.names).write.option("header", True).csv(raw)
    times, state, e = {}, {}, S.EVENTS

    def stage(name, build):
        t0 = time.perf_counter()
        state[name] = cut_lineage(build(), f"bench-{name}")
        times[name] = round(time.perf_counter() - t0, 3)

    stage("LoadCSV", lambda: read_readings(spark, raw))
    stage("Pivot", lambda: pivot_metrics(state["LoadCSV"], EVENT_METRICS).withColumns(
        {a: F.col(a).cast("int") for a in S.ALARMS}))
    stage("Preprocessing", lambda: fill_nearest(build_blocks(cut_lineage(create_grid(
        state["Pivot"], e.grid_interval, alarms=S.ALARMS, binary=S.ENGINES, metrics=S.GRID_COLS)),
        e.block_gap, split_seconds=e.split_seconds), S.PREPARED_FILL, e.fill_gap))
    stage("AnomalyDetection", lambda: detect_anomalies(
        state["Preprocessing"], e.switch_separator, e.switch_threshold, S.ENGINES, keep_input=True))
    stage("Correlations", lambda: pairwise_correlation(
        state["AnomalyDetection"], list(S.SENSORS), "flag_anomaly"))
    stage("PredictiveMaintenance", lambda: composite.maintenance_frame(
        state["AnomalyDetection"], EVENT_ROLES, e, features=["engine", "flag_anomaly"]))
    stage("Model", lambda: composite.maintenance_report(
        state["PredictiveMaintenance"], list(FEATURES), 3 * 24 * 60, 12 * 60, model="rf",
        n_trees=40))
    return times


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from vigil.session import checkpoint_dir, get_session
    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:
        # Spark's event log (stage and task times) into a scratch folder
        os.makedirs(log_dir, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="vigil-bench",
                        extra=extra)
    checkpoint_dir(spark)
    from vigil.plans.catalog import QUERIES
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # warm-up on the small tables: JIT-compiles the same code paths so the
    # timed pass measures steady-state execution
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm):
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    if os.path.isdir(warm):
        run_stages(spark, warm)
    stages = run_stages(spark, sf_dir)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "stages": stages, "sf": sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
