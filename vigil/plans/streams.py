"""Streaming runs over file sources derived from the driver tables: each stages
its input under the shared checkpoint folder, runs the stream to completion
(``availableNow``) and returns the sink table as a DataFrame. Used by the
registry, the tests (stream = batch) and the bench."""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir
from vigil.sources import tables
from vigil.streaming import count_window, scoring
from vigil.streaming.sources import file_stream, trade_stream


def scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _stage(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


STATE_PARTITIONS = 16         # least partitions of a stateful stream
STATE_ROWS = 1_000_000        # more rows of its log take more partitions


def state_partitions(rows: int, most: int) -> int:
    """Partitions of a stateful stream over a log of ``rows`` rows. Each one
    commits its own state files in every micro-batch, whatever it holds, so
    they follow the rows; ``most`` (the session's shuffle width) bounds them."""
    return min(most, max(STATE_PARTITIONS, -(-rows // STATE_ROWS)))


@contextmanager
def _state_width(spark: SparkSession, src: str):
    """The shuffle width for a stateful stream over the files of ``src`` that is
    started inside: a query takes the settings of its start along and keeps the
    width in its checkpoint. Counting reads the footers."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    rows = spark.read.schema(_PRED_SCHEMA).parquet(src).count()
    spark.conf.set(name, str(state_partitions(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scored_log_stream(spark: SparkSession, sf_dir: str, run) -> DataFrame:
    """M1 over the trade messages of ``events`` (JSON lines)."""
    return spark.read.parquet(score_events(spark, sf_dir, run.features, run.model) + "/log")


def score_events(spark: SparkSession, sf_dir: str, features, model, threshold: float = 0.5,
                 messages: DataFrame | None = None, **options) -> str:
    """Stream the trade messages of ``events`` (or ``messages``) through M1;
    the folder holds ``log``, ``alerts`` and ``quarantine``."""
    base = scratch(spark, "m1")
    src = _stage((messages if messages is not None else tables.trade_json(spark, sf_dir)).select("value"),
                 f"{base}/src", "text")
    q = scoring.start_scoring(trade_stream(spark, "text", path=src), features, model, f"{base}/log", f"{base}/ckpt",
                              alerts_path=f"{base}/alerts", quarantine_path=f"{base}/quarantine",
                              threshold=threshold, **options)
    _run(q)
    return base


_PRED_SCHEMA = ("id bigint, ts timestamp, symbol string, price double, quantity double, "
                "is_buyer_maker boolean, fraud_score double, is_fraud int")


LANDING_DAYS = 5              # one landing of the log: that many days of files, in no order among themselves
DELAY = f"{LANDING_DAYS} days"
PART_ROWS = 500_000           # rows of a file that a landing is read from


def _log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.predictions(spark, sf_dir).select(
        "id", F.col("ts").cast("timestamp").alias("ts"), "symbol", "price", "quantity", "is_buyer_maker",
        "fraud_score", "is_fraud")


def _prediction_source(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    return file_stream(spark, _stage(_log_rows(spark, sf_dir), f"{base}/src"), _PRED_SCHEMA)


def _land(rows: DataFrame, path: str, days: int = LANDING_DAYS, heartbeat: bool = False) -> list:
    """The log as it lands: files of ``days`` days at a time, appended one
    landing after the other, whose rows and files are in no order. Returns the
    landings (functions that write one each). The log is read and split once,
    into a folder per landing: a filter per landing would read it that often,
    with all the work in one task where the log is kept by time. ``heartbeat``
    lands a last failed score behind the end plus the delay."""
    spark = rows.sparkSession
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    steps = 0 if first is None else (last - first).days // days + 1
    put = lambda part: part.write.mode("append").parquet(path)
    landings = []
    if steps:
        since = F.unix_micros("ts") - F.unix_micros(F.lit(first))
        width = F.lit(days * 86_400_000_000)
        number = ((since - F.pmod(since, width)) / width).cast("int")
        (rows.where(F.col("ts").isNotNull()).withColumn("_landing", number)
         .write.option("maxRecordsPerFile", str(PART_ROWS)).partitionBy("_landing").parquet(f"{path}-landings"))
        split = spark.read.parquet(f"{path}-landings")
        landings = [lambda k=k: put(split.where(F.col("_landing") == k).drop("_landing")) for k in range(steps)]
    if heartbeat and steps:
        beat = spark.range(1).select(*[
            F.lit(last + _dt.timedelta(days=days, seconds=1)).alias(c) if c == "ts" else
            F.lit(-1.0).alias(c) if c == "fraud_score" else F.lit(None).cast(rows.schema[c].dataType).alias(c)
            for c in rows.columns])
        landings.append(lambda: put(beat))
    if not landings:
        landings.append(lambda: put(rows))
    return landings


def running_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 in complete mode; each batch overwrites the one-row result."""
    base = scratch(spark, "m2")
    out = f"{base}/out"

    def sink(batch: DataFrame, _bid: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (scoring.running_totals(_prediction_source(spark, sf_dir, base))
         .writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out)


def _volume_run(spark: SparkSession, base: str, watermark: str, files_per_trigger: int) -> None:
    src = file_stream(spark, f"{base}/src", _PRED_SCHEMA, max_files_per_trigger=files_per_trigger)
    _run(src.where("fraud_score >= 0").writeStream.foreachBatch(
        scoring.volume_writer(f"{base}/buckets", f"{base}/late", f"{base}/marks", watermark))
        .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())


def volume_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 8) -> DataFrame:
    """M3 over a log that lands in parts: the stream runs after the first
    landing, stops, and runs again from its checkpoint (M6) over the rest."""
    base = scratch(spark, "m3")
    first, *rest = _land(_log_rows(spark, sf_dir), f"{base}/src")
    first()
    _volume_run(spark, base, DELAY, files_per_trigger)
    for landing in rest:
        landing()
    _volume_run(spark, base, DELAY, files_per_trigger)
    return scoring.volume_buckets(spark, f"{base}/buckets")


def volume_with_late_rows(spark: SparkSession, sf_dir: str, watermark: str = "1 hour",
                          files: int = 16) -> tuple[DataFrame, DataFrame]:
    """M3 over files that hold rows of all times, with a short watermark:
    (buckets, late rows)."""
    base = scratch(spark, "m3-late")
    _log_rows(spark, sf_dir).repartition(files, "id").write.parquet(f"{base}/src")
    _volume_run(spark, base, watermark, max(1, files // 4))
    return scoring.volume_buckets(spark, f"{base}/buckets"), scoring.late_rows(spark, f"{base}/late")


def count_window_stream(spark: SparkSession, sf_dir: str, key: str = "is_buyer_maker",
                        files_per_trigger: int = 8, n: int = count_window.COUNT_WINDOW) -> DataFrame:
    """M4 keyed by ``key``, append mode, over a log whose files are in no order
    within a landing; a closing heartbeat releases the last rows."""
    base = scratch(spark, "m4")
    out = f"{base}/out"
    for landing in _land(_log_rows(spark, sf_dir), f"{base}/src", heartbeat=True):
        landing()
    src = file_stream(spark, f"{base}/src", _PRED_SCHEMA, max_files_per_trigger=files_per_trigger)
    windows = count_window.ordered_count_window_drift_stream(src, DELAY, key=key, n=n)
    with _state_width(spark, f"{base}/src"):
        query = (windows.writeStream.outputMode("append").format("parquet").option("path", out)
                 .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _run(query)
    return spark.read.schema(windows.schema).parquet(out)


def drift_sink(spark: SparkSession, sf_dir: str, key: str = "symbol", n: int = 10) -> str:
    """K9: the drift rows of M4 written by batch; returns the folder."""
    base = scratch(spark, "k9")
    for landing in _land(_log_rows(spark, sf_dir), f"{base}/src", heartbeat=True):
        landing()
    src = file_stream(spark, f"{base}/src", _PRED_SCHEMA, max_files_per_trigger=4)
    windows = count_window.ordered_count_window_drift_stream(src, DELAY, key=key, n=n)
    with _state_width(spark, f"{base}/src"):
        query = (windows.writeStream.outputMode("append").foreachBatch(scoring.drift_writer(f"{base}/drift"))
                 .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _run(query)
    return f"{base}/drift"
