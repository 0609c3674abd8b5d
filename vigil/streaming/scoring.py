"""Live scoring and stream aggregates (M1–M3, K1, K3).

M1 is ``readStream → parse (F13) → map (F10) → score (E7) → flag (P4)`` and a
``foreachBatch`` that writes the prediction log (K1), the alerts (K3) and the
quarantine of messages that are not JSON. The log has the ten columns of the
batch writer, so the drift job reads either. Each micro-batch overwrites only
its own ``run``/``batch`` partition (dynamic partition overwrite), so a batch
replayed after a failure rewrites the same files instead of duplicating rows,
and a query with a new checkpoint does not touch the batches of an older one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.scalars import flag, round6
from vigil.operators import trades as trd
from vigil.operators import train
from vigil.operators.train import top_deviations
from vigil.sources.readers import LOG_COLUMNS

DEFAULT_WATERMARK = "10 seconds"
STATUS_METRICS = "scorer_status"
VOLUME_WIDTH = "5 seconds"


def score_trades(raw: DataFrame, features, model, threshold: float = 0.5,
                 scale: bool = False) -> DataFrame:
    """Parse → map → score → flag; works on batch and streaming frames. The log
    columns, ``parsed``, the raw message and ``features`` (unscaled values, a
    struct). A message without numbers where they belong scores −1.0 and is
    never flagged; one that is not JSON has ``parsed`` false. ``scale`` applies
    the fitted scaler to what the model sees."""
    cols = list(features.feature_cols)
    mapped = trd.map_trade(trd.parse_trades(raw), cols, features.log_transform_cols)
    told = mapped.withColumn("_told", F.struct(*cols))
    if scale:
        told = told.withColumns({
            c: F.lit(0.0) if not features.stds[c] else (F.col(c) - F.lit(features.means[c])) / F.lit(features.stds[c])
            for c in cols})
    scored = train.score(model, told, valid=trd.inputs_valid())
    made = F.coalesce("trade_ms", "event_ms")
    return scored.select(
        F.date_format(F.timestamp_millis(made), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "trade_id", F.col("_symbol").alias("symbol"),
        F.col("_price").cast("string").alias("price"), F.col("_quantity").cast("string").alias("quantity"),
        made.alias("trade_time"), F.col("is_buyer_maker"),
        round6(F.col("fraud_score")).alias("fraud_score"),
        flag("fraud_score", threshold).alias("is_fraud"),
        F.lit(float(threshold)).alias("threshold"),
        F.col("_parsed").alias("parsed"), F.col("value").alias("message"), F.col("_told").alias("features"))


def log_writer(log_path: str, alerts_path: str | None = None, features=None, k: int = 5,
               quarantine_path: str | None = None, run: str = "0"):
    """K1 + K3 + quarantine as a ``foreachBatch`` function. ``dt`` is the day of
    the trade, or of arrival when the trade names none, so date pruning loses no
    row; ``run`` keeps queries with different checkpoints apart."""
    def put(out: DataFrame, path: str) -> None:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt", "run", "batch").parquet(path))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Persist first: the batch plan (scoring, observed metrics) then runs
        # once, whatever number of actions follow.
        batch = batch.persist()
        try:
            out = batch.withColumns({
                "run": F.lit(run), "batch": F.lit(int(batch_id)),
                "dt": F.to_date(F.coalesce(F.timestamp_millis("trade_time"), F.current_timestamp()))})
            keys = ["dt", "run", "batch"]
            put(out.where("parsed").select(*LOG_COLUMNS, *keys), log_path)
            if quarantine_path:
                put(out.where(~F.col("parsed")).select("message", *keys), quarantine_path)
            if alerts_path:
                alerts = top_deviations(out.where(F.col("parsed") & (F.col("is_fraud") == 1)), features.feature_cols, k,
                                        features.means, features.stds, values="features")
                put(alerts.select(*LOG_COLUMNS, "top_deviations", *keys), alerts_path)
        finally:
            batch.unpersist()
    return write


def start_scoring(raw_stream: DataFrame, features, model, log_path: str, checkpoint: str,
                  alerts_path: str | None = None, threshold: float = 0.5, trigger: dict | None = None,
                  dedup_watermark: str | None = None, quarantine_path: str | None = None, scale: bool = False):
    """M1. ``dedup_watermark`` drops repeats of a (symbol, trade id) that arrive
    within that time of each other, for at-least-once sources. Time of arrival
    is what is compared, so an old trade is never late; messages without an id
    are not comparable and all stay."""
    scored = score_trades(raw_stream, features, model, threshold, scale)
    if dedup_watermark:
        known = F.col("parsed") & F.col("trade_id").isNotNull()
        scored = (scored.withColumns({
            "_arrived": F.current_timestamp(),
            "_same": F.when(known, F.concat_ws(":", "symbol", F.col("trade_id").cast("string"))).otherwise(F.uuid())})
            .withWatermark("_arrived", dedup_watermark)
            .dropDuplicatesWithinWatermark(["_same"]).drop("_arrived", "_same"))
    # A20 live: per-batch reader status in StreamingQueryProgress.observedMetrics.
    scored = scored.observe(
        STATUS_METRICS, F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("fraud_score") < 0).alias("errors"),
        F.max("trade_time").alias("last_trade_ms"))
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    w = scored.writeStream.foreachBatch(
        log_writer(log_path, alerts_path, features, quarantine_path=quarantine_path, run=run)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def reader_status(query) -> dict:
    """A20 of the recent batches of a live query (as many as Spark keeps the
    progress of); ``log_status`` has the totals."""
    total = errors = 0
    last = None
    for p in query.recentProgress:
        m = (p.get("observedMetrics") or {}).get(STATUS_METRICS) if isinstance(p, dict) else \
            (p.observedMetrics or {}).get(STATUS_METRICS)
        if m:
            total += int(m["total"] or 0)
            errors += int(m["errors"] or 0)
            last = m["last_trade_ms"] if m["last_trade_ms"] is not None else last
    return {"total": total, "errors": errors, "last_trade_ms": last}


def log_status(spark: SparkSession, log_path: str, quarantine_path: str | None = None) -> DataFrame:
    """A20 totals from the tables the stream writes, whatever its age: messages,
    errors (failed scores and quarantined messages), time of the last trade."""
    rows = spark.read.parquet(log_path).select("fraud_score", "trade_time")
    out = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("fraud_score") < 0).alias("errors"),
                   F.max("trade_time").alias("last_trade_ms"))
    if quarantine_path is None:
        return out
    bad = spark.read.schema("message string, dt date").parquet(quarantine_path).agg(F.count(F.lit(1)).alias("bad"))
    return out.join(bad).select((F.col("total") + F.col("bad")).alias("total"),
                                (F.col("errors") + F.col("bad")).alias("errors"), "last_trade_ms")


def running_totals(scored: DataFrame) -> DataFrame:
    """M2: total scored, flagged, flag rate (complete/update output mode)."""
    agg = scored.groupBy().agg(F.count(F.lit(1)).alias("total"),
                               F.sum(F.col("is_fraud").cast("bigint")).alias("flagged"))
    return agg.select("total", "flagged",
                      F.coalesce(F.try_divide(F.col("flagged").cast("double"),
                                              F.col("total").cast("double")), F.lit(0.0)).alias("flag_rate"))


def volume_stream(scored: DataFrame, ts_col: str = "ts", width: str = VOLUME_WIDTH,
                  watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """M3: event-time tumbling buckets with a watermark (append mode emits a
    bucket once the watermark passes its end; update mode emits changes)."""
    return (scored.withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, width).alias("w"))
            .agg(F.count("fraud_score").alias("total"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud"),
                 F.avg("fraud_score").alias("avg_score"))
            .select(F.col("w.start").alias("bucket_start"), "total", "fraud", "avg_score"))


def _put_batch(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Write the partitions of a micro-batch; a replayed one replaces them."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


BUCKET_SCHEMA = "bucket_start timestamp, total bigint, fraud bigint, score_sum double, batch bigint"


def volume_writer(path: str, late_path: str, marks_path: str, watermark: str = DEFAULT_WATERMARK,
                  ts_col: str = "ts", width: str = VOLUME_WIDTH):
    """M3 as a ``foreachBatch`` function that loses no row. Each micro-batch
    writes what it adds to its buckets under its own ``batch`` (an upsert keyed
    by bucket and batch, merged by ``volume_buckets``), its rows behind the
    watermark to ``late_path``, and the latest event time so far to
    ``marks_path``, of which the next batch reads one row. The watermark of a
    batch is the latest event time of the earlier ones less ``watermark``; rows
    without a time count as late."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn(ts_col, F.col(ts_col).cast("timestamp")).persist()
        try:
            seen = None
            if batch_id > 0:
                seen = spark.read.schema("seen timestamp, batch bigint").parquet(marks_path).where(
                    F.col("batch") == batch_id - 1).agg(F.max("seen")).first()[0]
            line = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
            late = F.col(ts_col).isNull() if seen is None else F.coalesce(F.col(ts_col) < line, F.lit(True))
            mark = F.lit(int(batch_id)).cast("bigint").alias("batch")
            _put_batch(batch.where(late).select("*", mark), late_path, ["batch"])
            added = batch.where(~late).groupBy(F.window(ts_col, width)["start"].alias("bucket_start")).agg(
                F.count("fraud_score").alias("total"), F.sum(F.col("is_fraud").cast("bigint")).alias("fraud"),
                F.sum("fraud_score").alias("score_sum"))
            _put_batch(added.select("*", mark), path, ["batch"])
            # Last: a batch that fails before has no mark and is run again.
            _put_batch(batch.agg(F.greatest(F.max(ts_col), F.lit(seen).cast("timestamp")).alias("seen"))
                       .select("seen", mark), marks_path, ["batch"])
        finally:
            batch.unpersist()
    return write


def volume_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The buckets that ``volume_writer`` keeps: the sums over its batches."""
    added = spark.read.schema(BUCKET_SCHEMA).parquet(path)
    return added.groupBy("bucket_start").agg(
        F.sum("total").alias("total"), F.sum("fraud").alias("fraud"),
        F.try_divide(F.sum("score_sum"), F.sum("total").cast("double")).alias("avg_score"))


def late_rows(spark: SparkSession, path: str, schema: str = "id bigint, ts timestamp, fraud_score double, is_fraud int") -> DataFrame:
    return spark.read.schema(schema + ", batch bigint").parquet(path)


def drift_writer(path: str, run: str = "0", ts_col: str = "ts"):
    """K9 as a ``foreachBatch`` function: drift rows by day, run and batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _put_batch(batch.withColumns({"dt": F.to_date(ts_col), "run": F.lit(run),
                                      "batch": F.lit(int(batch_id)).cast("bigint")}), path, ["dt", "run", "batch"])
    return write
