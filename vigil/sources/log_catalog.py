"""Catalogue of prediction-log files.

A CSV log file names its columns in its own header, and writers of different
versions order them differently, lack some or add new ones. The catalogue holds
one row per file: (file, mtime, dt, header), where ``header`` is null for a file
without a usable one. It is a small Parquet table that grows by the files that
are new or changed since the last refresh; a refresh lists files by date (no
content is read) and reads lines of those files only. Readers then know the
layouts of the dates they are asked for before they read a line.

A header is a line that names ``timestamp`` and at least one more known column;
no line of values does. Unknown names are allowed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = "file string, mtime timestamp, dt string, header string"
KEY_COLUMN = "timestamp"


@dataclass(frozen=True)
class Span:
    """What is asked for: bounds as timestamp text, of rows or of files."""
    since: str | None = None
    until: str | None = None
    by: str = "row"
    strict: bool = False

    def prune(self, df: DataFrame) -> DataFrame:
        """The files that can hold such rows: by the ``dt`` partition, or by
        modification time; both reach the listing of the scan."""
        if self.by == "mtime":
            at = F.col("_metadata.file_modification_time")
            if self.since is not None:
                lo = F.lit(self.since).cast("timestamp")
                df = df.where(at > lo if self.strict else at >= lo)
            return df if self.until is None else df.where(at <= F.lit(self.until).cast("timestamp"))
        if "dt" in df.columns:
            if self.since is not None:
                df = df.where(F.col("dt") >= F.to_date(F.lit(self.since)))
            if self.until is not None:
                df = df.where(F.col("dt") <= F.to_date(F.lit(self.until)))
        return df


EVERYTHING = Span()


def missing_path(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def names_of(header: str) -> list[str]:
    return [x.strip().strip('"').strip() for x in header.split(",")]


def is_header(line, columns: list[str]):
    names = F.transform(F.split(line, ","), lambda x: F.trim(F.regexp_replace(x, '"', "")))
    known = F.array_intersect(names, F.array(*map(F.lit, columns)))
    return F.array_contains(names, F.lit(KEY_COLUMN)) & (F.size(known) > 1)


def lines(spark: SparkSession, path: str, span: Span = EVERYTHING) -> DataFrame:
    """The lines of the files of the span, with their file and its time."""
    return span.prune(spark.read.text(path)).withColumns({
        "_file": F.col("_metadata.file_path"), "_mtime": F.col("_metadata.file_modification_time")})


def files(spark: SparkSession, path: str, span: Span = EVERYTHING) -> DataFrame:
    """(file, mtime, dt) of the span, from the listing alone."""
    found = span.prune(spark.read.format("binaryFile").load(path))
    dt = F.col("dt").cast("string") if "dt" in found.columns else F.lit(None).cast("string")
    return found.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("mtime"), dt.alias("dt"))


def _describe(spark: SparkSession, path: str, span: Span, wanted: DataFrame, columns: list[str], first=None) -> DataFrame:
    """``wanted`` files (none older than ``first``) with their headers, from
    their lines. Files without any line (empty flushes) have an empty header:
    nothing to read, nothing lost. The lines stay where they are read: the list
    of files (a row each) goes to them, and of a file at most its distinct
    headers and one null leave a task, kept in a hash map, not sorted."""
    text = lines(spark, path, span).where(F.col("value") != "")
    if first is not None:
        text = text.where(F.col("_mtime") >= F.lit(first))          # the scan leaves out older files
    heads = text.join(F.broadcast(wanted.select(F.col("file").alias("_file"))), "_file", "left_semi").select(
        F.col("_file").alias("file"), F.when(is_header(F.col("value"), columns), F.col("value")).alias("header"))
    # Counts of (file, header) first: a minimum of texts alone would sort every line.
    per_file = heads.groupBy("file", "header").agg(F.count(F.lit(1)).alias("lines")).groupBy("file").agg(
        F.min("header").alias("header"), (F.sum("lines") > 0).alias("told"))
    return wanted.join(per_file, "file", "left").select(
        "file", "mtime", "dt", F.when(F.col("told"), F.col("header")).otherwise(F.lit("")).alias("header"))


def read_catalog(spark: SparkSession, catalog: str) -> DataFrame:
    """The latest row of each file."""
    try:
        rows = spark.read.schema(CATALOG_SCHEMA).parquet(catalog)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], CATALOG_SCHEMA)
    latest = F.max_by(F.struct("mtime", "dt", "header"), "mtime").alias("r")
    return rows.groupBy("file").agg(latest).select("file", "r.*")


def refresh(spark: SparkSession, path: str, catalog: str, columns: list[str], span: Span = EVERYTHING) -> int:
    """Add the files of the span that the catalogue does not know at their
    present time; returns their number. Running it again adds nothing."""
    listed = files(spark, path, span)
    fresh = listed.join(read_catalog(spark, catalog), ["file", "mtime"], "left_anti")
    bounds = fresh.agg(F.count(F.lit(1)).alias("n"), F.min("mtime").alias("first")).first()
    if bounds["n"]:
        _describe(spark, path, span, fresh, columns, bounds["first"]).coalesce(1).write.mode("append").parquet(catalog)
    return bounds["n"]


def headers(spark: SparkSession, path: str, columns: list[str], span: Span = EVERYTHING,
            catalog: str | None = None) -> DataFrame:
    """(file, mtime, dt, header) of the span's files; with a catalogue only new
    files are read for it."""
    listed = files(spark, path, span)
    if catalog is None:
        return _describe(spark, path, span, listed, columns)
    refresh(spark, path, catalog, columns, span)
    return listed.join(read_catalog(spark, catalog).drop("dt"), ["file", "mtime"])
