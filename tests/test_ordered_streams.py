"""Event-time ordered count windows, volume buckets with late rows, compaction
of flushes, drift from a stored baseline, encoders by size."""

import datetime as dt
import glob
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import drift, features
from vigil.sources import readers, sinks
from vigil.streaming import scoring
from vigil.streaming.count_window import ordered_count_window_drift_stream

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, symbol string, fraud_score double, is_fraud int"


def _files(spark, path, groups):
    """One file per group; modification times follow the list."""
    for i, rows in enumerate(groups):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        for f in glob.glob(os.path.join(path, "part-*")):
            if os.path.getmtime(f) > time.time() - 1e6:
                os.utime(f, (1e9 + i, 1e9 + i))


def _run(writer, ck):
    q = writer.option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None


def _scores(n, seed=3):
    rng = random.Random(seed)
    return [(i, BASE + dt.timedelta(seconds=i), "AB"[i % 3 == 0] if i % 11 else None,
             -1.0 if i % 7 == 0 else round(rng.random(), 6), int(i % 5 == 0)) for i in range(n)]


def test_ordered_stream_equals_batch_from_unordered_files(spark, tmp_dir):
    """Rows up to 60 s out of order, within files and between them; equal times;
    the batch operator over the whole log gives the same windows."""
    rows = _scores(600) + [(9000 + i, BASE + dt.timedelta(seconds=300), "A", 0.25, 0) for i in range(5)]
    rng = random.Random(1)
    arrival = sorted(rows, key=lambda r: (r[1] - BASE).total_seconds() + rng.uniform(0, 60))
    beat = [(None, BASE + dt.timedelta(seconds=1000), None, -1.0, 0)]
    src = os.path.join(tmp_dir, "src")
    _files(spark, src, [arrival[k:k + 100] for k in range(0, len(arrival), 100)] + [beat])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    out = os.path.join(tmp_dir, "out")
    _run(ordered_count_window_drift_stream(stream, "90 seconds", n=10).writeStream.outputMode("append")
         .format("parquet").option("path", out), os.path.join(tmp_dir, "ck"))
    want = drift.count_window_drift(spark.createDataFrame(rows, SCHEMA), n=10, by=["symbol"], digits=None)
    key = lambda df: {(r["symbol"], r["window_no"]): (r["ts"], round(r["drift_score"], 6), round(r["mean_score"], 9))
                      for r in df.collect()}
    got, want = key(spark.read.parquet(out)), key(want)
    assert len(got) > 30 and got == want


def test_ordered_stream_holds_rows_until_the_watermark(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    _files(spark, src, [_scores(200)])
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    windows = ordered_count_window_drift_stream(stream, "100 seconds", n=10)
    _run(windows.writeStream.outputMode("append").format("parquet").option("path", out), os.path.join(tmp_dir, "ck"))
    last = spark.read.schema(windows.schema).parquet(out).agg(F.max("ts")).first()[0]
    assert last is not None and last < BASE + dt.timedelta(seconds=99)


def test_volume_counts_late_rows_and_survives_a_replay(spark, tmp_dir):
    rows = _scores(300)
    src = os.path.join(tmp_dir, "src")
    # The first file reaches far ahead; the second lies behind the watermark in part.
    _files(spark, src, [rows[200:], rows[:200], [(1, None, "A", 0.5, 0)]])
    paths = [os.path.join(tmp_dir, n) for n in ("buckets", "late", "marks")]
    write = scoring.volume_writer(*paths, watermark="150 seconds")
    seen = []

    def twice(batch, bid):                                # a batch that is replayed after its write
        write(batch, bid)
        write(batch, bid)
        seen.append(bid)

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    _run(stream.writeStream.foreachBatch(twice), os.path.join(tmp_dir, "ck"))
    assert len(seen) == 3
    late = {r["id"] for r in scoring.late_rows(spark, paths[1]).where("ts is not null").collect()}
    assert late == {r[0] for r in rows[:200] if r[1] < rows[299][1] - dt.timedelta(seconds=150)}
    assert scoring.late_rows(spark, paths[1]).where("ts is null").count() == 1
    total = scoring.volume_buckets(spark, paths[0]).agg(F.sum("total")).first()[0]
    assert total + len(late) == 300


FLUSH = "id long, score double"


def _flush(spark, path, day, run, batch, ids):
    (spark.createDataFrame([(i, i / 10) for i in ids], FLUSH)
     .withColumns({"dt": F.lit(dt.date(2024, 1, day)), "run": F.lit(run), "batch": F.lit(batch).cast("bigint")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run", "batch").parquet(path))


def test_compaction_keeps_every_row_once(spark, tmp_dir):
    path, merged = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "merged")
    for batch in range(6):
        _flush(spark, path, 1 + batch % 2, "a", batch, range(batch * 10, batch * 10 + 10))
    ids = lambda: sorted(r["id"] for r in sinks.read_flushes(spark, path, merged, FLUSH).collect())
    assert ids() == list(range(60))                                     # nothing merged yet
    sinks.compact_flushes(spark, path, merged, FLUSH, until=dt.date(2024, 1, 1))
    assert ids() == list(range(60))
    files = glob.glob(os.path.join(merged, "dt=*", "*.parquet"))
    assert len(files) == 1 and "dt=2024-01-01" in files[0]
    _flush(spark, path, 1, "b", 0, [100, 100])                          # late flush, with a repeated row
    _flush(spark, path, 1, "a", 0, range(10))                           # replayed flush
    assert ids() == sorted([*range(60), 100, 100])
    for _ in range(2):                                                  # a second run changes nothing
        sinks.compact_flushes(spark, path, merged, FLUSH)
        assert ids() == sorted([*range(60), 100, 100])
    assert len(glob.glob(os.path.join(merged, "dt=*", "*.parquet"))) == 2


def test_compaction_splits_a_large_day(spark, tmp_dir):
    path, merged = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "merged")
    _flush(spark, path, 3, "a", 0, range(100))
    sinks.compact_flushes(spark, path, merged, FLUSH, rows_per_file=10)
    assert sinks.read_flushes(spark, path, merged, FLUSH).count() == 100
    assert spark.read.parquet(merged).select(F.input_file_name()).distinct().count() > 1


def test_psi_from_stored_histogram_has_open_ends(spark, tmp_dir):
    rng = np.random.default_rng(5)
    train, live = rng.normal(0, 1, 500), np.r_[rng.normal(0.5, 2, 300), [-50.0, 60.0]]
    t = spark.createDataFrame([(float(v), 3.0, None) for v in train], "x double, same double, none double")
    a = spark.createDataFrame([(float(v), w, 1.0) for v, w in zip(live, [2.0, 3.0, 4.0] * 200)],
                              "x double, same double, none double")
    a = a.unionByName(spark.createDataFrame([(None, float("nan"), None)], a.schema))
    cols = ["x", "same", "none"]
    path = os.path.join(tmp_dir, "base")
    sinks.cache_baseline(t, cols, path)
    moments, hist = readers.read_baseline(spark, path)
    got = {r["feature"]: r for r in drift.psi_from_baseline(hist, a, cols).collect()}
    edges = np.linspace(train.min(), train.max(), 11)
    e = np.histogram(train, edges)[0]
    b = np.histogram(np.clip(live, edges[0], edges[-1]), edges)[0]
    ep, ap = (e + 1e-6) / (e.sum() + 1e-5), (b + 1e-6) / (b.sum() + 1e-5)
    assert got["x"]["psi"] == pytest.approx(float(np.sum((ap - ep) * np.log(ap / ep))), rel=1e-9)
    assert got["x"]["actual_n"] == len(live) and got["same"]["actual_n"] == len(live)
    assert got["same"]["psi"] > 0.2 and set(got) == {"x", "same"}
    z = {r["feature"]: r for r in drift.zscore_from_baseline(moments, a, cols).collect()}
    assert set(z) == {"x"}                                              # std 0 and empty features are skipped
    assert z["x"]["z"] == pytest.approx(abs(live.mean() - train.mean()) / train.std(ddof=1), abs=1e-4)
    empty = drift.psi_from_baseline(hist, a.limit(0), cols).collect()
    assert {r["feature"] for r in empty} == {"x", "same"} and all(r["psi"] is None for r in empty)


def test_encoders_by_size(spark, monkeypatch):
    """Broadcast encoders move no wide row; larger ones give the same codes."""
    df = spark.createDataFrame([(i, f"v{i % 50}", "ab"[i % 2] if i % 5 else None) for i in range(200)],
                               "id long, big string, small string")
    enc = features.cut_lineage(features.fit_encoders(df, ["big", "small"]))
    assert features.small_encoders(enc, ["big", "small"]) == {"big", "small"}
    assert features.small_encoders(enc, ["big", "small"], values=20) == {"small"}
    assert features.small_encoders(enc, ["big", "small"], chars=3) == set()
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    wide = features.join_encoders(df, enc, ["big", "small"])
    assert "SortMergeJoin" not in plan(wide) and "hashpartitioning" not in plan(wide)
    rows = sorted(map(tuple, wide.collect()))
    monkeypatch.setattr(features, "BROADCAST_VALUES", 20)
    assert sorted(map(tuple, features.join_encoders(df, enc, ["big", "small"]).collect())) == rows
    monkeypatch.setattr(features, "BROADCAST_VALUES", 1)
    assert sorted(map(tuple, features.join_encoders(df, enc, ["big", "small"]).collect())) == rows
    assert [r[1:] for r in rows[:2]] == [(0.0, 2.0), (1.0, 1.0)]
