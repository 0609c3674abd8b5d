"""Streams by bucket of keys, headers of large log files, propagation that moves."""

import datetime as dt
import os

from pyspark.sql import functions as F

from vigil.llm import sharding
from vigil.operators import drift
from vigil.plans import streams
from vigil.sources import log_catalog as cat
from vigil.sources import readers
from vigil.streaming.count_window import ordered_count_window_drift_stream

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, symbol string, fraud_score double"


def _drift_stream(spark, tmp_dir, rows, n, ends=5000):
    """The windows of ``rows`` and the rows its state ends with."""
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    beat = [(None, BASE + dt.timedelta(seconds=ends), None, -1.0)]
    spark.createDataFrame(rows + beat, SCHEMA).repartition(4).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "2").parquet(src)
    windows = ordered_count_window_drift_stream(stream, "1800 seconds", n=n)
    q = (windows.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.schema(windows.schema).parquet(out), q.lastProgress["stateOperators"][0]["numRowsTotal"]


def _values(df):
    return {(r["symbol"], r["window_no"]): (r["ts"], round(r["drift_score"], 9), round(r["mean_score"], 9),
                                            round(r["std_score"], 9)) for r in df.collect()}


def _same_as_batch(spark, rows, got, n):
    want = _values(drift.count_window_drift(spark.createDataFrame(rows, SCHEMA), n=n, by=["symbol"], digits=None))
    assert len(want) > 100 and _values(got) == want


def test_many_symbols_share_a_bounded_number_of_states(spark, tmp_dir):
    """One call and one state row per bucket, not per symbol."""
    rows = [(i, BASE + dt.timedelta(milliseconds=(i * 7919) % 1_500_000), f"S{i % 1500}" if i % 13 else None,
             -1.0 if i % 17 == 0 else (i * 37 % 1000) / 1000) for i in range(9000)]
    got, states = _drift_stream(spark, tmp_dir, rows, 2)
    assert states <= 513
    _same_as_batch(spark, rows, got, 2)


def test_one_symbol_meets_its_state_once_per_batch(spark, tmp_dir):
    """A key's rows come to the stateful step packed, whatever the Arrow batch
    size by which Spark would hand the waiting rows over again."""
    rows = [(i, BASE + dt.timedelta(milliseconds=(i * 7919) % 1_500_000), "A", (i * 37 % 1000) / 1000) for i in range(3000)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "20")
    try:
        got, _ = _drift_stream(spark, tmp_dir, rows, 10)
        _same_as_batch(spark, rows, got, 10)
    finally:
        spark.conf.set(size, before)
    stream = spark.readStream.schema(SCHEMA).parquet(os.path.join(tmp_dir, "src"))
    plan = ordered_count_window_drift_stream(stream, "1 hour")._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan


def test_headers_of_large_files_need_no_sort_of_their_lines(spark, tmp_dir):
    """Lines are neither moved by file nor sorted; (file, header) go out hashed."""
    path = os.path.join(tmp_dir, "log")
    lines = lambda head, k: spark.createDataFrame([(head,), *[(f"2024-01-01 00:00:0{i},{k}",) for i in range(9)]], "value string")
    for k, head in enumerate(["timestamp,trade_id", "trade_id,timestamp", "2024-01-02 00:00:00,7"]):
        lines(head, k).coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([("",)], "value string").write.mode("append").text(path)
    found = cat.files(spark, path)
    told = cat._describe(spark, path, cat.EVERYTHING, found, readers.LOG_COLUMNS)
    plan = told._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("hashpartitioning(file"):]
    assert "HashAggregate" in below and "SortAggregate" not in below and "SortMergeJoin" not in below
    assert sorted((r["header"] is None, r["header"] or "") for r in told.collect()) == [
        (False, ""), (False, "timestamp,trade_id"), (False, "trade_id,timestamp"), (True, "")]


def test_propagation_brings_the_rows_of_a_key_together(spark, monkeypatch):
    """Without the rounds the keys stay cut; with them nodes move and few are."""
    df = spark.createDataFrame([(g * 4 + i, f"k{g}") for g in range(150) for i in range(4)], "doc_id bigint, key string")
    share = lambda: (lambda c: c["cut"] / c["edges"])(sharding.cut_edges(sharding.balanced_shards(df, 5)).first())
    with_rounds = share()
    monkeypatch.setattr(sharding, "propagate", lambda nodes, *_: nodes)
    assert with_rounds < 0.2 and share() > 0.4


def test_the_log_is_read_once_for_all_its_landings(spark, tmp_dir):
    """One pass for the range of times and one for the rows, not one a landing;
    each landing holds its own days."""
    read = spark.sparkContext.accumulator(0)

    def told(parts):
        for part in parts:
            read.add(len(part))
            yield part

    rows = [(i, None if i % 50 == 7 else BASE + dt.timedelta(hours=i), f"S{i % 5}", i / 1000) for i in range(700)]
    log = spark.createDataFrame(rows, SCHEMA).repartition(3).mapInPandas(told, SCHEMA)
    path = os.path.join(tmp_dir, "src")
    held = []
    for landing in streams._land(log, path, days=5):
        landing()
        held.append({r["id"] for r in spark.read.parquet(path).select("id").collect()})
    want = [{i for i in range(120 * (k + 1)) if i < 700 and i % 50 != 7} for k in range(6)]
    assert held == want and read.value == 2 * len(rows)


def _events(spark, path, n):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(i * 7919) % (n * 7)), i % 40, "error" if i % 17 == 0 else "view",
             float(i * 37 % 400), '{"k": 5}') for i in range(n)]
    (spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
     .write.parquet(os.path.join(path, "events.parquet")))


def test_the_state_of_a_stream_is_as_wide_as_its_rows_need(spark, tmp_dir, monkeypatch):
    """Not as wide as the session's shuffles: each partition commits its files
    in every micro-batch. The session keeps its own width."""
    assert [streams.state_partitions(n, 200) for n in (0, 16_000_000, 16_000_001, 10 ** 9)] == [16, 16, 17, 200]
    assert streams.state_partitions(10 ** 9, 4) == 4
    _events(spark, tmp_dir, 2400)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    monkeypatch.setattr(streams, "scratch", lambda _, part: os.path.join(tmp_dir, part))
    spark.conf.set(name, "24")
    try:
        path = streams.drift_sink(spark, tmp_dir)
        assert spark.conf.get(name) == "24"
    finally:
        spark.conf.set(name, before)
    states = os.path.join(tmp_dir, "k9", "ckpt", "state", "0")
    assert len([p for p in os.listdir(states) if p.isdigit()]) == streams.STATE_PARTITIONS
    log = spark.read.parquet(os.path.join(tmp_dir, "k9", "src")).where("id is not null")
    want = _values(drift.count_window_drift(log, n=10, by=["symbol"], digits=None))
    assert len(want) > 100 and _values(spark.read.parquet(path)) == want
