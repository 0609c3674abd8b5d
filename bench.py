"""
null-rate and correlation profile (A1, A18), mean-shift drift (D1), PSI (D3),
exact AUC + threshold table (E2, E3), boosted-tree training (E6, reference
parameters) and streaming scoring over a file source (M1).

Prints one JSON line. Each query is executed in full with the ``noop`` sink
(no collect to the driver).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigil.session import get_session  # noqa: E402


def wide_frame(spark, sf_dir: str):
    """64 feature columns and a label from the vectors of ``embeddings``."""
    from pyspark.sql import functions as F

    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(64)],
                    (F.col("label") % 2).cast("int").alias("isFraud"))


def wide(spark, sf_dir: str) -> dict:
    """Seconds and cells per second of the per-column operators at 64 columns."""
    from vigil.operators import features, profile

    df = wide_frame(spark, sf_dir)
    cols = [c for c in df.columns if c.startswith("f")]
    cells = df.count() * len(cols)
    runs = {
        "a1_null_rates": lambda: profile.null_rates(df, cols),
        "f5_scaler": lambda: features.fit_scaler(df, cols),
        "f7_fit_apply": lambda: features.fit_features(df, categorical=[], drop_cols=["vec_id"]).transform(df),
    }
    out = {"cells": cells}
    for name, run in runs.items():
        t0 = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        s = time.perf_counter() - t0
        out[name] = {"sec": round(s, 3), "cells_per_sec": round(cells / s)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="vigil-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    from vigil.plans.registry import QUERIES
    from vigil.plans import training

    headline = ["f7_apply_features", "a1_null_rates", "a18_label_correlation",
                "d1_mean_shift_drift", "d3_psi_score", "d5_count_window_drift",
                "e2_roc_auc", "e3_threshold_metrics", "a12_score_histogram",
                "e6_train_classifier", "m1_score_trades_stream"]
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["a9_summary_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in headline:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        rows[name] = df.count() if name not in ("f7_apply_features",) else -1
    n_lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_wall", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "rows_in": {"lineitem": n_lineitem, "events": n_events},
        "wide": wide(spark, sf_dir),
        "train_trees": training.training_run(spark, sf_dir).model.stages[-1].getNumTrees,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
