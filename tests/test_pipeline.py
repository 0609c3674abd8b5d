"""End to end: raw → features → model → streaming scorer → log; sinks and
readers; stream = batch."""

import contextlib
import datetime as dt
import glob
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import TRADE, raw_transactions
from vigil.operators import evaluate as ev
from vigil.operators import features as feat
from vigil.operators import train
from vigil.plans import drift_job
from vigil.sources import log_catalog, readers, sinks
from vigil.sources import tables
from vigil.streaming import scoring
from vigil.streaming.sources import kafka_source_options, trade_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    raw = spark.createDataFrame(raw_transactions(500))
    fm = feat.fit_features(raw)
    m = fm.transform(raw)
    model = train.train_classifier(m, fm.feature_cols, "isFraud", class_weight=fm.class_weight, maxIter=5)
    return fm, model


def test_end_to_end_no_nulls(spark, fitted):
    fm, _ = fitted
    out = fm.transform(spark.createDataFrame(raw_transactions(500, seed=1)))
    assert out.dropna().count() == 500


def test_streaming_scorer_logs_and_alerts(spark, fitted, tmp_dir):
    fm, model = fitted
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    msgs = [TRADE, dict(TRADE, t=2, p="65000.00", q="0.01500"), dict(TRADE, t=3, q="abc"), "{broken"]
    with open(os.path.join(src, "part-0.txt"), "w") as fh:
        fh.write("\n".join(json.dumps(m) if isinstance(m, dict) else m for m in msgs) + "\n")
    q = scoring.start_scoring(trade_stream(spark, "text", path=src), fm, model,
                              os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ckpt"),
                              alerts_path=os.path.join(tmp_dir, "alerts"), threshold=0.0,
                              quarantine_path=os.path.join(tmp_dir, "bad"))
    q.awaitTermination()
    log = readers.read_prediction_logs(spark, os.path.join(tmp_dir, "log"), fmt="parquet")
    rows = {r["trade_id"]: r for r in log.collect()}
    assert len(rows) == 3
    assert rows[777]["fraud_score"] >= 0 and rows[3]["fraud_score"] == -1.0 and rows[3]["is_fraud"] == 0
    assert rows[777]["ts"].isoformat() == "2024-03-05T06:07:08"
    assert [r["message"] for r in spark.read.parquet(os.path.join(tmp_dir, "bad")).collect()] == ["{broken"]
    alerts = spark.read.parquet(os.path.join(tmp_dir, "alerts")).collect()
    assert {r["trade_id"] for r in alerts} == {777, 2}
    status = scoring.reader_status(q)
    assert status["total"] == 4 and status["errors"] == 2
    totals = scoring.log_status(spark, os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "bad")).first()
    assert totals.asDict() == status
    known = {"TransactionAmt", "hour_of_day", "day_of_week"}
    for r in alerts:                                    # no filled feature is called deviating
        assert {d["feature"] for d in r["top_deviations"]} <= known and r["top_deviations"]
        devs = [d["deviation"] for d in r["top_deviations"]]
        assert devs == sorted(devs, reverse=True)


def test_dedup_keeps_messages_without_an_id_and_old_trades(spark, fitted, tmp_dir):
    fm, model = fitted
    src = os.path.join(tmp_dir, "src")
    old = dict(TRADE, t=5, T=TRADE["T"] - 10**9, E=TRADE["E"] - 10**9)
    no_id = {k: v for k, v in TRADE.items() if k != "t"}
    batches = [[TRADE, TRADE, "{a", "{b", "{c"], [TRADE, old, no_id, no_id]]
    os.makedirs(src)
    for i, msgs in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.txt"), "w") as fh:
            fh.write("\n".join(json.dumps(m) if isinstance(m, dict) else m for m in msgs) + "\n")
    q = scoring.start_scoring(trade_stream(spark, "text", path=src, max_files_per_trigger=1), fm, model,
                              os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ckpt"),
                              quarantine_path=os.path.join(tmp_dir, "bad"), dedup_watermark="1 hour")
    q.awaitTermination()
    ids = sorted(r["trade_id"] or 0 for r in spark.read.parquet(os.path.join(tmp_dir, "log")).collect())
    assert ids == [0, 0, 5, 777]
    assert spark.read.parquet(os.path.join(tmp_dir, "bad")).count() == 3


_BATCH = ("timestamp string, trade_id bigint, symbol string, price string, quantity string, trade_time bigint, "
          "is_buyer_maker boolean, fraud_score double, is_fraud int, threshold double, parsed boolean, message string")


def test_replayed_batch_is_idempotent_and_runs_stay_apart(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    row = ("2024-01-01T00:00:00", 1, "a", "1", "1", 1704067200000, False, 0.1, 0, 0.5, True, "")
    batch = spark.createDataFrame([row], _BATCH)
    scoring.log_writer(path, run="a")(batch, 7)
    scoring.log_writer(path, run="a")(batch, 7)
    assert spark.read.parquet(path).count() == 1
    scoring.log_writer(path, run="b")(batch, 7)
    scoring.log_writer(path, run="b")(batch.limit(0), 8)
    assert spark.read.parquet(path).count() == 2


def test_two_flushes_both_stay(spark, tmp_dir):
    log = tables.predictions(spark, SF)
    sinks.write_prediction_log(log.where("id < 100"), tmp_dir)
    sinks.write_prediction_log(log.where("id >= 100 AND id < 150"), tmp_dir)
    assert readers.read_prediction_logs(spark, tmp_dir).count() == log.where("id < 150").count()


def test_logs_are_read_by_column_name(spark, tmp_dir):
    for name, text in {
            "a.csv": "timestamp,trade_id,fraud_score,threshold\n2024-01-01T00:00:00,1,0.5,0.8\n",
            "b.csv": "threshold,fraud_score,trade_id,timestamp,symbol\n0.7,0.25,2,2024-01-02T00:00:00,x\n",
            "c.csv": "1,2,3\n4,5,6\n"}.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    rows = readers.read_prediction_logs(spark, tmp_dir).orderBy("trade_id").collect()
    assert [(r["trade_id"], r["fraud_score"], r["threshold"], r["symbol"]) for r in rows] == [
        (1, 0.5, 0.8, None), (2, 0.25, 0.7, "x")]
    bad = readers.rejected_log_files(spark, tmp_dir).collect()
    assert [os.path.basename(r["file"]) for r in bad] == ["c.csv"]


def _write(folder, name, text):
    os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def _mixed_logs(folder):
    _write(folder, "dt=2024-01-01/a.csv", "timestamp,trade_id,fraud_score,model_version\n2024-01-01T01:00:00,1,0.5,v7\n")
    _write(folder, "dt=2024-01-02/b.csv", "model_version,trade_id,timestamp,model_version\nv8,2,2024-01-02T00:00:00,x\n"
                                          "v8,3,not a time,y\n")
    _write(folder, "dt=2024-01-02/c.csv", "a,b\n1,2\n")
    _write(folder, "dt=2024-01-03/d.csv", "trade_id,timestamp,fraud_score\n4,2024-01-03T00:00:00,0.25\n")


@pytest.mark.parametrize("with_catalog", [False, True])
def test_unknown_columns_lose_no_row_and_foreign_files_are_named(spark, tmp_dir, with_catalog):
    logs, catalog = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "catalog") if with_catalog else None
    _mixed_logs(logs)
    read = lambda **k: sorted(
        (r["trade_id"], r["fraud_score"]) for r in readers.read_prediction_logs(spark, logs, catalog=catalog, **k).collect())
    assert read() == [(1, 0.5), (2, None), (3, None), (4, 0.25)]
    assert read(since="2024-01-02 00:00:00", until="2024-01-02 23:00:00") == [(2, None)]
    assert read(since="2024-01-01 00:00:00", until="2024-01-03 00:00:00", strict=True) == [(1, 0.5), (2, None), (4, 0.25)]
    bad = readers.rejected_log_files(spark, logs, catalog=catalog).collect()
    assert [os.path.basename(r["file"]) for r in bad] == ["c.csv"]
    assert readers.rejected_log_files(spark, logs, since="2024-01-03 00:00:00", catalog=catalog).count() == 0
    assert readers.rejected_log_files(spark, os.path.join(tmp_dir, "none"), catalog=catalog).count() == 0


def test_catalogue_grows_by_new_files_only(spark, tmp_dir):
    logs, catalog = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "catalog")
    _mixed_logs(logs)
    day = log_catalog.Span(since="2024-01-02", until="2024-01-02")
    assert log_catalog.refresh(spark, logs, catalog, readers.LOG_COLUMNS, day) == 2
    assert log_catalog.refresh(spark, logs, catalog, readers.LOG_COLUMNS) == 2
    assert log_catalog.refresh(spark, logs, catalog, readers.LOG_COLUMNS) == 0
    _write(logs, "dt=2024-01-04/e.csv", "trade_id,timestamp\n5,2024-01-04T00:00:00\n")
    _write(logs, "dt=2024-01-04/empty.csv", "")
    _write(logs, "dt=2024-01-02/c.csv", "timestamp,trade_id\n2024-01-02T05:00:00,6\n")     # mended
    stamp = os.stat(os.path.join(logs, "dt=2024-01-02/c.csv")).st_mtime + 5
    os.utime(os.path.join(logs, "dt=2024-01-02/c.csv"), (stamp, stamp))
    assert log_catalog.refresh(spark, logs, catalog, readers.LOG_COLUMNS) == 2      # Spark lists no file without bytes
    back = readers.read_prediction_logs(spark, logs, catalog=catalog)
    assert sorted(r["trade_id"] for r in back.collect()) == [1, 2, 3, 4, 5, 6]
    assert readers.rejected_log_files(spark, logs, catalog=catalog).count() == 0


def test_only_the_dates_asked_for_are_read(spark, tmp_dir):
    _mixed_logs(tmp_dir)
    text = log_catalog.lines(spark, tmp_dir, log_catalog.Span(since="2024-01-03", until="2024-01-03"))
    assert [os.path.basename(f) for f in text.inputFiles()] and text.select("_file").distinct().count() == 1
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        text.explain()
    assert "PartitionFilters: [isnotnull(dt" in out.getvalue()


def test_drift_job_runs_again_with_the_same_reports(spark, tmp_dir):
    logs, reports = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "reports")
    sinks.write_prediction_log(tables.predictions(spark, SF), logs)
    _write(logs, "dt=2024-01-29/foreign.csv", "a,b\n1,2\n")
    kinds = []
    for _ in range(2):
        drift_job.run_drift_job(spark, logs, reports, dt.datetime(2024, 1, 30), catalog=os.path.join(tmp_dir, "catalog"))
        kinds.append(sorted(map(tuple, spark.read.parquet(reports).collect())))
    assert kinds[0] == kinds[1]
    assert "rejected_logs" in {r["kind"] for r in spark.read.parquet(reports).collect()}


def test_prediction_log_csv_roundtrip(spark, tmp_dir):
    log = tables.predictions(spark, SF)
    sinks.write_prediction_log(log, tmp_dir)
    files = glob.glob(os.path.join(tmp_dir, "dt=*", "*.csv"))
    assert files and open(files[0]).readline().startswith("timestamp,trade_id,symbol")
    back = readers.read_prediction_logs(spark, tmp_dir)
    assert back.count() == log.count()
    assert back.agg(F.sum("fraud_score")).first()[0] == pytest.approx(log.agg(F.sum("fraud_score")).first()[0])


def test_log_reader_mtime_mode_and_missing_path(spark, tmp_dir):
    sinks.write_prediction_log(tables.predictions(spark, SF), tmp_dir)
    assert readers.read_prediction_logs(spark, tmp_dir, since="2000-01-01 00:00:00", by="mtime").count() == 1000
    assert readers.read_prediction_logs(spark, tmp_dir, since="2999-01-01 00:00:00", by="mtime").count() == 0
    empty = readers.read_prediction_logs(spark, os.path.join(tmp_dir, "nothing-here"))
    assert empty.count() == 0 and "fraud_score" in empty.columns


def test_read_transactions_empty_dir_raises(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "empty"))
    for name in ("empty", "missing"):
        with pytest.raises(readers.EmptyInputError):
            readers.read_transactions(spark, os.path.join(tmp_dir, name), schema="a int")


def test_export_label_first(spark, tmp_dir):
    df = spark.createDataFrame([(1.0, 2.0, 1)], "a double, b double, isFraud int")
    sinks.export_label_first(df, ["a", "b"], "isFraud", tmp_dir)
    # The dataset may hold empty part files next to the one with the row.
    lines = [ln.strip() for f in sorted(glob.glob(os.path.join(tmp_dir, "*.csv")))
             for ln in open(f) if ln.strip()]
    assert lines == ["1,1.0,2.0"]


def test_append_report_partitions_by_kind(spark, tmp_dir):
    r = spark.createDataFrame([(0.9,)], "auc double")
    sinks.append_report(r, tmp_dir, "evaluation")
    sinks.append_report(r, tmp_dir, "evaluation")
    sinks.append_report(r, tmp_dir, "drift")
    back = spark.read.parquet(tmp_dir)
    assert {(x["kind"], x["count"]) for x in back.groupBy("kind").count().collect()} == {("evaluation", 2), ("drift", 1)}


def test_kafka_options():
    o = kafka_source_options("b:9092", "trades", "latest", 1000)
    assert o["startingOffsets"] == "latest" and o["subscribe"] == "trades" and o["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(ValueError):
        kafka_source_options("b:9092", "t", "middle")


def test_volume_stream_appends_with_watermark(spark, tmp_dir):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, 0, s), 0.1 * (s % 3), int(s % 3 == 2)) for s in range(0, 60, 3)]
    src = os.path.join(tmp_dir, "src")
    spark.createDataFrame(rows, "ts timestamp, fraud_score double, is_fraud int").write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, fraud_score double, is_fraud int").parquet(src)
    out = os.path.join(tmp_dir, "out")
    q = (scoring.volume_stream(stream).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    # append mode emits only buckets the watermark (max ts − 10 s) has passed
    assert got.count() > 0 and got.agg(F.max("bucket_start")).first()[0] <= dt.datetime(2024, 1, 1, 0, 0, 50)
    assert got.agg(F.sum("total")).first()[0] <= len(rows)


def test_count_window_stream_state_across_batches(spark, tmp_dir):
    """Several micro-batches (one file each, in time order) give the same
    windows as the batch operator: state carries the open window and the
    running moments between batches."""
    import datetime as dt
    import time
    import numpy as np
    from vigil.operators import drift
    from vigil.streaming.count_window import count_window_drift_stream
    rng = np.random.default_rng(9)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=i), "A" if i % 3 else "B", float(np.round(rng.random(), 6)))
            for i in range(420)]
    schema = "id long, ts timestamp, symbol string, fraud_score double"
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    for j in range(0, 420, 70):                       # 6 files, written in time order
        spark.createDataFrame(rows[j:j + 70], schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmp_dir, "out")
    q = (count_window_drift_stream(stream, key="symbol", n=50).writeStream.outputMode("append")
         .format("parquet").option("path", out).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["symbol"], r["window_no"]): (r["drift_score"], r["mean_score"])
           for r in spark.read.parquet(out).collect()}
    batch = drift.count_window_drift(spark.createDataFrame(rows, schema), n=50, by=["symbol"], digits=None)
    exp = {(r["symbol"], r["window_no"]): (r["drift_score"], r["mean_score"]) for r in batch.collect()}
    assert set(got) == set(exp) and len(exp) == 7
    for k, (z, m) in exp.items():
        assert got[k][0] == pytest.approx(z, rel=1e-9, abs=1e-12) and got[k][1] == pytest.approx(m)


def test_metric_docs_missing_path_is_empty(spark, tmp_dir):
    schema = "auc double, deployed_at string"
    assert readers.read_metric_docs(spark, os.path.join(tmp_dir, "none"), schema).count() == 0
    spark.createDataFrame([(0.9, "2024-01-01")], schema).write.json(os.path.join(tmp_dir, "m"))
    assert readers.read_metric_docs(spark, os.path.join(tmp_dir, "m"), schema).first()["auc"] == 0.9


def test_heatmap_wide_zero_filled(spark):
    import datetime as dt
    from vigil.operators import monitor
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 5), 0.2), (dt.datetime(2024, 1, 1, 0, 1, 15), 0.6)]
    p = spark.createDataFrame(rows, "ts timestamp, fraud_score double")
    long = monitor.score_heatmap(p)
    minutes = [dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 1)]
    wide = {r["slot"]: list(r)[1:] for r in monitor.score_heatmap_wide(long, minutes).collect()}
    assert wide == {0: [0.2, 0.0], 10: [0.0, 0.6]}


def test_round6_matches_python_round(spark):
    from vigil.functions.scalars import round6
    import numpy as np
    rng = np.random.default_rng(4)
    vals = [0.1234565, 0.5, 2.675, 1.0000005, 0.03125, 0.12345649, -1.0000005, -0.0000125, 0.0,
            123456789.1234565, 2.5e-7, 1.5e-6, 0.0000005]
    vals += (np.round(rng.random(300), 7) + 0.0).tolist() + (rng.integers(0, 10 ** 8, 200) / 10 ** 7 + 5e-8).tolist()
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(round6("x")).collect()]
    assert got == [round(v, 6) for v in vals]


def test_daily_drift_job(spark, tmp_dir):
    import datetime as dt
    from vigil.plans.drift_job import run_drift_job
    from vigil.sources import sinks as sk
    now = dt.datetime(2024, 1, 30)
    base = tables.predictions(spark, "/root/testdata/sf0.01")
    shifted = base.withColumn("fraud_score", F.when(
        (F.col("ts") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")) & (F.col("fraud_score") >= 0),
        F.least(F.col("fraud_score") + 0.2, F.lit(1.0))).otherwise(F.col("fraud_score")))
    logs = os.path.join(tmp_dir, "logs")
    sk.write_prediction_log(shifted, logs)
    res = run_drift_job(spark, logs, os.path.join(tmp_dir, "reports"), now).first()
    assert res["decision"] == "drift_detected" and res["drift_score"] > 0.05
    kinds = {r["kind"]: r["count"] for r in spark.read.parquet(os.path.join(tmp_dir, "reports"))
             .groupBy("kind").count().collect()}
    assert kinds == {"drift": 1, "drift_alert": 1, "retrain_request": 1}
