"""Monitoring queries behind the operations dashboard (A9–A13, A20, T1–T3,
P5, P9, P12, F12). Each is a plain aggregation or top-k over the prediction
table; top-k plans as ``TakeOrderedAndProject`` (per-partition top-k, then a
merge of k rows per partition), never a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.bins import fixed_unit_bin
from vigil.functions.scalars import parse_log_time, safe_ratio, score_band

# Fixed values of the dashboard.
RECENT_LIMIT = 500
ALERT_LIMIT = 50
DRIFT_HISTORY_LIMIT = 200
VOLUME_BUCKET_SECONDS = 10
VOLUME_BUCKETS_SHOWN = 60
HIST_BINS = 40
HEATMAP_SLOT_SECONDS = 10


def summary_stats(preds: DataFrame, by=()) -> DataFrame:
    """A9 + P12: total, flagged, legit, flag rate %, avg/max score, avg price."""
    agg = preds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("is_fraud").cast("bigint")).alias("flagged"),
        F.avg("fraud_score").alias("avg_score"),
        F.max("fraud_score").alias("max_score"),
        F.avg(F.col("price").cast("double")).alias("avg_price"))
    flagged0 = F.coalesce(F.col("flagged"), F.lit(0).cast("bigint"))
    return agg.select(
        *by, "total", "flagged", "avg_score", "max_score", "avg_price",
        (F.col("total") - flagged0).alias("legit"),
        (safe_ratio(flagged0.cast("double"), F.col("total").cast("double")) * 100).alias("flag_rate_pct"))


def volume_over_time(preds: DataFrame, bucket_seconds: int = VOLUME_BUCKET_SECONDS,
                     limit: int = VOLUME_BUCKETS_SHOWN, ts_col: str = "ts") -> DataFrame:
    """A10: buckets restart every minute (minute + floor(sec/b)·b), newest
    ``limit`` buckets, as ISO text."""
    ts = F.col(ts_col)
    sec = (F.floor(F.second(ts) / bucket_seconds) * bucket_seconds).cast("int")
    bucket = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:"), F.lpad(sec.cast("string"), 2, "0"))
    return (preds.groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("total"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_count"),
                 F.avg("fraud_score").alias("avg_score"))
            .orderBy(F.desc("bucket")).limit(limit))


def volume_by_window(preds: DataFrame, width: str = "5 seconds", ts_col: str = "ts") -> DataFrame:
    """Event-time tumbling buckets; empty buckets do not appear."""
    return (preds.groupBy(F.window(ts_col, width).alias("w"))
            .agg(F.count("fraud_score").alias("total"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud"),
                 F.avg("fraud_score").alias("avg_score"))
            .select(F.col("w.start").alias("bucket_start"), "total", "fraud", "avg_score"))


def score_histogram(preds: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """A12 (+P5): bins of width 1/bins over [0, 1] per label, zero-filled.

    The grid (2 × bins rows) is generated, not joined from data, and the
    counts side is at most 2 × bins rows."""
    spark = preds.sparkSession
    counts = (preds.groupBy(F.col("is_fraud").cast("int").alias("is_fraud"),
                            fixed_unit_bin("fraud_score", bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    grid = (spark.range(1).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("is_fraud"))
            .select("is_fraud", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")))
    return (grid.join(F.broadcast(counts), ["is_fraud", "bin"], "left")
            .select("is_fraud", "bin",
                    (F.col("bin") / F.lit(float(bins))).alias("bin_start"),
                    F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def score_heatmap(preds: DataFrame, slot_seconds: int = HEATMAP_SLOT_SECONDS, ts_col="ts") -> DataFrame:
    """A13 long form: mean score per (minute, 10-second slot)."""
    ts = F.col(ts_col)
    return (preds.groupBy(F.date_trunc("minute", ts).alias("minute"),
                          (F.floor(F.second(ts) / slot_seconds) * slot_seconds).cast("int").alias("slot"))
            .agg(F.avg("fraud_score").alias("mean_score"), F.count(F.lit(1)).alias("n")))


def score_heatmap_wide(long: DataFrame, minutes: list) -> DataFrame:
    """A13 wide form: slot rows × the given minute columns, missing = 0.
    Pivot values are explicit, so no extra job collects them."""
    return (long.groupBy("slot").pivot("minute", minutes).agg(F.first("mean_score"))
            .fillna(0.0))


def recent(preds: DataFrame, limit: int = RECENT_LIMIT, ts_col="ts", tie="id") -> DataFrame:
    """Newest ``limit`` rows (tie-break on id)."""
    return preds.orderBy(F.desc(ts_col), F.desc(tie)).limit(limit)


def fraud_alerts(preds: DataFrame, limit: int = ALERT_LIMIT) -> DataFrame:
    """T2 (+P5): newest flagged rows."""
    return recent(preds.where(F.col("is_fraud") == 1), limit)


def drift_history(drift_rows: DataFrame, limit: int = DRIFT_HISTORY_LIMIT) -> DataFrame:
    """Newest drift rows."""
    return drift_rows.orderBy(F.desc("ts"), F.desc("window_no")).limit(limit)


def reader_status(log: DataFrame, ts_col="ts") -> DataFrame:
    """A20 (+P6): successful scores, errors, last successful timestamp."""
    ok = F.col("fraud_score") >= 0
    return log.agg(F.count_if(ok).alias("total"),
                   F.count_if(F.col("fraud_score") < 0).alias("errors"),
                   F.max(F.when(ok, F.col(ts_col))).alias("last_ts"))


def with_score_band(preds: DataFrame) -> DataFrame:
    """P9."""
    return preds.withColumn("band", score_band("fraud_score"))


def log_time_parts(log_text: DataFrame, text_col="timestamp") -> DataFrame:
    """ISO text → timestamp, hour, floor minute, 10-second slot."""
    ts = parse_log_time(text_col)
    return log_text.select("*", ts.alias("parsed_ts")).select(
        "*", F.hour("parsed_ts").alias("hour"),
        F.date_trunc("minute", "parsed_ts").alias("minute"),
        (F.floor(F.second("parsed_ts") / 10) * 10).cast("int").alias("slot"))
