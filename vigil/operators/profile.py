"""Profiling of a (wide) transaction table: null rates, class balance,
category and quantile label rates, histograms, correlations (A1–A4,
A14–A19, T5, T6, P11).

Per-column statistics go through ``unpivot`` + ``groupBy("column")``: one
shuffle for all columns whose size is columns × partitions partial rows, far
cheaper than one ``agg`` with thousands of expressions on wide tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.bins import equal_width_bin
from vigil.operators.quantiles import exact_quantiles

NULL_THRESHOLD = 0.9   # a column is dropped when strictly more than 90 % is null


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns by type, minus ``exclude`` (the label)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def _is_missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(c)           # NaN counts as missing, as in pandas
    return m.cast("double")


def null_rates(df: DataFrame, cols=None) -> DataFrame:
    """A1: (column, null_rate) for every column, NULL and NaN both missing."""
    cols = list(cols or df.columns)
    flags = df.select(*[_is_missing(df, c).alias(c) for c in cols])
    return (flags.unpivot([], cols, "column", "missing")
            .groupBy("column").agg(F.avg("missing").alias("null_rate")))


def overall_null_rate(rates: DataFrame) -> DataFrame:
    return rates.agg(F.avg("null_rate").alias("overall_null_rate"))


def top_null_columns(rates: DataFrame, n: int = 20) -> DataFrame:
    """T5."""
    return (rates.where(F.col("null_rate") > 0)
            .orderBy(F.desc("null_rate"), F.asc("column")).limit(n))


def high_null_columns(rates: DataFrame, threshold: float = NULL_THRESHOLD) -> list[str]:
    """A2 decision (strictly greater than ``threshold``). ``rates`` has one row
    per column, so collecting it is bounded by the schema width."""
    return sorted(r["column"] for r in rates.where(F.col("null_rate") > threshold).collect())


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """A3: count and share per label value, negatives per positive (int)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()   # over ≤ a handful of label rows
    total = F.sum("n").over(everything)
    neg = F.sum(F.when(F.col("label") == 0, F.col("n"))).over(everything)
    pos = F.sum(F.when(F.col("label") == 1, F.col("n"))).over(everything)
    return counts.select("label", "n", (F.col("n") / total).alias("rate"),
                         F.floor(F.try_divide(neg, pos)).cast("bigint").alias("neg_per_pos"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """A4: negatives / positives (NULL when there are no positives)."""
    return df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"),
                               F.count_if(F.col(label) == 1).cast("double")).alias("class_weight"))


def label_rate_by_category(df: DataFrame, col: str, label: str) -> DataFrame:
    """Mean label per non-null value, highest first."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(F.col(col).alias("value"))
            .agg(F.avg(F.col(label).cast("double")).alias("label_rate"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("label_rate"), F.asc("value")))


def quantile_edges(df: DataFrame, col: str, q: int = 10) -> list[float]:
    """Exact, linearly interpolated edges at 0, 1/q, …, 1, duplicates dropped."""
    edges = exact_quantiles(df, col, [i / q for i in range(q + 1)])
    out = []
    for e in edges:
        if e is not None and (not out or e != out[-1]):
            out.append(e)
    return out


def label_rate_by_quantile(df: DataFrame, col: str, label: str, q: int = 10) -> DataFrame:
    """Pandas ``qcut`` buckets — right-closed, lowest value included in
    bucket 1 — with label rate and count per bucket. Bucket = number of edges
    strictly below the value (at least 1)."""
    edges = quantile_edges(df, col, q)
    spark = df.sparkSession
    if len(edges) < 2:
        return spark.createDataFrame([], "bucket int, lower double, upper double, label_rate double, n bigint")
    x = F.col(col).cast("double")
    below = sum((x > F.lit(e)).cast("int") for e in edges)
    bucket = F.greatest(below, F.lit(1))
    edge_arr = F.array(*[F.lit(e) for e in edges])
    lower = F.element_at(edge_arr, F.col("bucket"))
    upper = F.element_at(edge_arr, F.col("bucket") + 1)
    return (df.where(x.isNotNull() & ~F.isnan(x))
            .groupBy(bucket.alias("bucket"))
            .agg(F.avg(F.col(label).cast("double")).alias("label_rate"),
                 F.count(F.lit(1)).alias("n"))
            .select("bucket", lower.alias("lower"), upper.alias("upper"), "label_rate", "n"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Min, exact median, mean, max."""
    med = exact_quantiles(df, col, [0.5])[0]
    return df.agg(F.min(col).cast("double").alias("min"),
                  F.lit(med).cast("double").alias("median"),
                  F.avg(col).alias("mean"), F.max(col).cast("double").alias("max"))


def histogram(df: DataFrame, col: str, bins: int = 100, log: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), zero-filled;
    ``log`` bins log1p(value)."""
    x = F.col(col).cast("double")
    x = F.log1p(x) if log else x
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    rng = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()[0]
    spark = df.sparkSession
    if rng["lo"] is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n bigint")
    lo, hi = float(rng["lo"]), float(rng["hi"])
    step = (hi - lo) / bins
    counts = vals.groupBy(equal_width_bin(F.col("x"), lo, hi, bins).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: F.when(i >= bins, F.lit(hi)).otherwise(i.cast("double") * step + lo)
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
                    F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def label_correlation(df: DataFrame, label: str, cols=None) -> DataFrame:
    """Pearson correlation of every numeric column with the label over
    the rows where the column is not null; constant column → NULL (a plain
    ``corr`` raises under ANSI when a variance is 0)."""
    cols = [c for c in (cols or numeric_columns(df, exclude=[label])) if c != label]
    long = (df.select(F.col(label).cast("double").alias("_y"),
                      *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(["_y"], cols, "column", "v")
            .where(F.col("v").isNotNull() & ~F.isnan("v") & F.col("_y").isNotNull()))
    r = F.try_divide(F.covar_pop("v", "_y"), F.stddev_pop("v") * F.stddev_pop("_y"))
    return long.groupBy("column").agg(r.alias("corr"))


def top_correlated(corr: DataFrame, n: int = 20) -> DataFrame:
    """Strongest absolute correlations first."""
    return (corr.where(F.col("corr").isNotNull())
            .orderBy(F.desc(F.abs("corr")), F.asc("column")).limit(n))


def distinct_label_check(df: DataFrame, label: str) -> DataFrame:
    """The label must take exactly two values."""
    return df.agg(F.count_distinct(label).alias("n_distinct")) \
        .withColumn("passed", F.col("n_distinct") == 2)
