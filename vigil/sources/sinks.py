"""Batch sinks (K1, K4–K8, K10). Streaming sinks (K1 per micro-batch, K3,
K9) are in ``vigil.streaming.scoring``."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.drift import PSI_BINS, feature_moments
from vigil.functions.bins import equal_width_bin


def write_prediction_log(log: DataFrame, path: str, fmt: str = "csv",
                         max_records_per_file: int | None = None) -> None:
    """K1 (batch form): append a flush of the 10-column log, with a header,
    partitioned by date so readers prune by ``dt``. Earlier flushes stay; an
    empty input adds no row."""
    ts = F.col("ts")
    out = log.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("id").alias("trade_id"), "symbol",
        F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("quantity"),
        "trade_time", "is_buyer_maker", "fraud_score", "is_fraud", "threshold",
        F.to_date(ts).alias("dt"))
    w = out.write.mode("append").option("header", "true").partitionBy("dt")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.format(fmt).save(path)


def write_features(matrix: DataFrame, feature_cols: list[str], label: str, path: str) -> None:
    """K4: feature columns in training order, label last."""
    matrix.select(*feature_cols, label).write.mode("overwrite").parquet(path)


def export_label_first(matrix: DataFrame, feature_cols: list[str], label: str, path: str) -> None:
    """K6: label first, no header (the trainer's CSV contract)."""
    matrix.select(label, *feature_cols).write.mode("overwrite").option("header", "false").csv(path)


def append_report(report: DataFrame, path: str, kind: str, at: _dt.datetime | None = None) -> None:
    """K7: add the rows of a report to the ``reports`` dataset, partitioned by
    kind and time of the report. Every kind has one shape, ``reported_at`` and
    the row as a JSON ``document`` (``readers.read_reports`` takes it apart); no
    rows add nothing. A report of the same kind and time replaces the earlier
    one (dynamic partition overwrite), so a job that runs again for its time
    leaves the same rows."""
    stamp = (at or _dt.datetime.now(_dt.timezone.utc)).isoformat()
    (report.select(F.to_json(F.struct("*")).alias("document"), F.lit(kind).alias("kind"), F.lit(stamp).alias("reported_at"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "reported_at").parquet(path))


def write_merged(df: DataFrame, path: str) -> None:
    """K8."""
    df.write.mode("overwrite").parquet(path)


def baseline_tables(train: DataFrame, features: list[str], bins: int = PSI_BINS) -> tuple[DataFrame, DataFrame]:
    """The training baseline kept as (feature, n, mean, std) plus
    equal-width bin counts per feature — instead of a raw 10,000-value sample
    — so later PSI and z-score checks read two small tables."""
    moments = feature_moments(train, features)
    long = train.select(*[F.col(c).cast("double").alias(c) for c in features]) \
        .unpivot([], features, "feature", "v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    # The range is one row per feature: it is aggregated map-side and attached
    # as a broadcast (bounded by the feature list), so raw rows never move.
    rng = long.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    hist = (long.join(F.broadcast(rng), "feature")
            .groupBy("feature", "lo", "hi", equal_width_bin(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    return moments, hist


def cache_baseline(train: DataFrame, features: list[str], path: str, bins: int = PSI_BINS) -> None:
    moments, hist = baseline_tables(train, features, bins)
    moments.write.mode("overwrite").parquet(f"{path}/moments")
    hist.write.mode("overwrite").parquet(f"{path}/histogram")


def read_flushes(spark: SparkSession, path: str, compacted: str, schema: str) -> DataFrame:
    """The rows of a sink written by (dt, run, batch), each once: days from
    ``compacted`` where a flush has been merged, the other flushes as they
    are. ``schema`` names the columns without the three keys."""
    keys = "dt date, run string, batch bigint"
    flushes = spark.read.schema(f"{schema}, {keys}").parquet(path)
    merged = _read_or_empty(spark, compacted, f"{schema}, run string, batch bigint, dt date")
    done = merged.select("dt", "run", "batch").distinct()
    return flushes.join(done, ["dt", "run", "batch"], "left_anti").unionByName(merged).drop("run", "batch")


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def compact_flushes(spark: SparkSession, path: str, compacted: str, schema: str, since: _dt.date | None = None,
                    until: _dt.date | None = None, rows_per_file: int = 5_000_000) -> None:
    """K1/K9: merge the small flushes of the days ``since``..``until`` into few
    files, one folder a day. The flushes stay; a merged row carries its (run,
    batch), by which ``read_flushes`` knows it. A day's folder is replaced when
    the job commits (dynamic partition overwrite), so a job that fails leaves
    the earlier state and one that runs again writes the same rows. Flushes
    that arrive later, or late in an old day, are read from their own files
    until the next run. A day is spread over tasks by hash of its batch and row,
    as many as its rows need."""
    rows = spark.read.schema(f"{schema}, dt date, run string, batch bigint").parquet(path)
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("dt") <= F.lit(until))
    # One row per day; AQE broadcasts it or splits a hot day.
    sizes = rows.groupBy("dt").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    salted = rows.join(sizes, "dt").withColumn("_part", F.pmod(F.xxhash64(
        *[f.name for f in rows.schema.fields if f.dataType.typeName() != "map"]), F.col("_files")))
    (salted.repartition("dt", "_part").drop("_files", "_part").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", str(rows_per_file))
     .partitionBy("dt").parquet(compacted))
