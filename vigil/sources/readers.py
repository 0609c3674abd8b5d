"""Batch readers.

Readers take explicit schemas (no inference on the hot path), so an empty or
missing input still yields a typed empty frame, and Catalyst can prune
columns and push predicates into the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources import log_catalog as cat

# Prediction log as written by the scorer (FIXTURES §6): text timestamps,
# price/quantity as received strings.
PREDICTION_LOG_SCHEMA = ("timestamp string, trade_id bigint, symbol string, price string, "
                         "quantity string, trade_time bigint, is_buyer_maker boolean, "
                         "fraud_score double, is_fraud int, threshold double")


class EmptyInputError(FileNotFoundError):
    pass


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: str | None = None) -> DataFrame:
    """Headered CSV (or parquet) of raw transactions; an input without
    files is an error, as in the reference trainer."""
    try:
        # Paths only: no content is read, no list of files comes to the driver.
        none = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").isEmpty()
    except AnalysisException as e:
        if not cat.missing_path(e):
            raise
        none = True
    if none:
        raise EmptyInputError(f"no input files under {path}")
    if fmt == "csv":
        r = spark.read.option("header", "true")
        r = r.schema(schema) if schema else r.option("inferSchema", "true")
        df = r.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df


def read_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Only the requested columns that exist (ColumnPruning reaches the
    scan)."""
    return df.select(*[c for c in cols if c in df.columns])


def sample_head(df: DataFrame, n: int = 1000, order: list[str] | None = None) -> DataFrame:
    """S3: the first ``n`` rows for cheap validation: of the scan (the limit is
    pushed down, no full read), or, with ``order``, of that order, which makes
    the sample repeatable (a top-n per partition, no full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def _ts(value) -> str:
    return value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)


LOG_COLUMNS = [f.split()[0] for f in PREDICTION_LOG_SCHEMA.split(", ")]
_LOG_TYPES = dict(f.split() for f in PREDICTION_LOG_SCHEMA.split(", "))


def _read_csv_logs(spark: SparkSession, path: str, span: cat.Span, catalog: str | None) -> DataFrame:
    """Values are matched with columns by the header of their own file, so files
    may order their columns differently, lack some or have more (which are left
    out). The layouts of the span (a few, however many files) come to the driver;
    each is parsed with its own order and the parts are united by name."""
    told = cat.headers(spark, path, LOG_COLUMNS, span, catalog)
    layouts = [r["header"] for r in told.select("header").distinct().orderBy("header").collect()]
    usable = [h for h in layouts if h]
    lines = cat.lines(spark, path, span)
    keep = [c for c in lines.columns if c not in ("value", "_file")]
    parts = []
    for header in usable:
        seen: set[str] = set()
        fields = []
        for i, name in enumerate(cat.names_of(header)):
            known = name in _LOG_TYPES and name not in seen
            seen.add(name)
            fields.append(f"{name} {_LOG_TYPES[name]}" if known else f"_other{i} string")
        rows = lines
        if len(usable) > 1 or None in layouts:             # else every line belongs to the one layout
            own = told.where(F.col("header") == header).select(F.col("file").alias("_file"))
            rows = lines.join(F.broadcast(own), "_file", "left_semi")      # a row per file, no line moves
        rows = rows.where((F.col("value") != header) & (F.col("value") != ""))
        wanted = [f"r.{c}" for c in _LOG_TYPES if c in seen]
        parts.append(rows.select(*keep, F.from_csv("value", ", ".join(fields)).alias("r")).select(*keep, *wanted))
    if not parts:
        return lines.where(F.lit(False)).select(
            *keep, *[F.lit(None).cast(t).alias(c) for c, t in _LOG_TYPES.items()])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def rejected_log_files(spark: SparkSession, path: str, since=None, until=None, by: str = "row",
                       catalog: str | None = None) -> DataFrame:
    """(file, reason) of the CSV log files of a range whose rows
    ``read_prediction_logs`` cannot take: they have lines, but no header."""
    span = cat.Span(None if since is None else _ts(since), None if until is None else _ts(until), by)
    try:
        told = cat.headers(spark, path, LOG_COLUMNS, span, catalog)
    except AnalysisException as e:
        if not cat.missing_path(e):
            raise
        return spark.createDataFrame([], "file string, reason string")
    return told.where(F.col("header").isNull()).select("file", F.lit("no header of known columns").alias("reason"))


def read_prediction_logs(spark: SparkSession, path: str, since=None, until=None,
                         by: str = "row", strict: bool = False, fmt: str = "csv",
                         catalog: str | None = None) -> DataFrame:
    """S4/S5 (+U1): every log file under ``path`` concatenated by column name
    (a column that a file lacks is null, unknown ones are left out); a missing
    path is an empty typed frame. Reads what both writers leave: the batch
    writer's CSV and the stream writer's Parquet (``fmt``). Unreadable files
    fail the job; files without a usable header are listed by
    ``rejected_log_files``. ``catalog`` names a table of known headers
    (``log_catalog``), kept up to date, so only new files are read for theirs.

    ``by="row"``   keeps rows whose parsed ``timestamp`` is in range; with a
                   ``dt=`` date layout the dates prune partitions before any
                   line is read.
    ``by="mtime"`` selects whole files by modification time (the reference's
                   rule) through the hidden ``_metadata`` column, which reaches
                   the scan's listing.
    ``strict`` makes the lower bound exclusive (S5)."""
    span = cat.Span(None if since is None else _ts(since), None if until is None else _ts(until), by, strict)
    try:
        if fmt == "csv":
            df = _read_csv_logs(spark, path, span, catalog)
        else:
            df = span.prune(spark.read.option("mergeSchema", "true").format(fmt).load(path))
    except AnalysisException as e:
        if not cat.missing_path(e):
            raise
        return spark.createDataFrame([], PREDICTION_LOG_SCHEMA).withColumn(
            "ts", F.lit(None).cast("timestamp"))
    extra = [c for c in ("dt",) if c in df.columns]
    df = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in _LOG_TYPES.items()],
                   *extra).withColumn("ts", F.try_to_timestamp("timestamp"))
    if by == "row":
        if since is not None:
            lo = F.lit(span.since).cast("timestamp")
            df = df.where(F.col("ts") > lo if strict else F.col("ts") >= lo)
        if until is not None:
            df = df.where(F.col("ts") <= F.lit(span.until).cast("timestamp"))
    return df


def read_metric_docs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents with a known schema; missing → empty frame (callers
    left-join / coalesce for the "none" case)."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if not cat.missing_path(e):
            raise
        return spark.createDataFrame([], schema)


def read_reports(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """The reports of one kind with their documents as columns; a missing
    dataset is an empty typed frame."""
    try:
        rows = spark.read.schema("document string, reported_at string, kind string").parquet(path)
    except AnalysisException as e:
        if not cat.missing_path(e):
            raise
        rows = spark.createDataFrame([], "document string, reported_at string, kind string")
    return rows.where(F.col("kind") == kind).select("reported_at", F.from_json("document", schema).alias("d")).select(
        "reported_at", "d.*")


def latest_reports(reports: DataFrame, n: int = 20, order_col: str = "completed_at") -> DataFrame:
    """The last ``n`` reports, returned oldest first."""
    return reports.orderBy(F.desc(order_col)).limit(n).orderBy(order_col)


def read_baseline(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """K10 read back: (moments, histogram) of ``sinks.cache_baseline``."""
    return (spark.read.schema("feature string, n bigint, mean double, std double").parquet(f"{path}/moments"),
            spark.read.schema("feature string, lo double, hi double, bin int, n bigint").parquet(f"{path}/histogram"))
