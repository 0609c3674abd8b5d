"""Feature pipeline.

Two phases, as in Spark ML:

* ``fit_features`` runs a few aggregation jobs. What reaches the driver is
  bounded by the schema: the null-rate decision (one row per column) and the
  scaler (one row per feature column). The encoders stay a table (one row per
  distinct category value) from fit to save, load and apply, so a column may
  have any number of values.
* ``FeatureModel.transform`` is one projection over an equi-join per
  categorical column. Encoders are counted first: those that fit
  ``BROADCAST_VALUES`` together are broadcast, so wide rows do not move for
  them; larger ones shuffle. The same plan runs on a stream (stream-static
  joins).

Order of the steps (fixed by the reference): time features → drop high-null
and fixed columns → log1p → label encoding (NULL → "missing") → fill the
remaining NULL/NaN with −999 → standard scaling of every numeric column with
the population std (constant column → 0) → class weight.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.scalars import NULL_FILL, time_features
from vigil.operators.profile import high_null_columns, null_rates
from vigil.operators.sequence import sequence_number
from vigil.session import cut_lineage

# Fixed values of the reference's feature engineering.
LABEL = "isFraud"
DROP_COLS = ["TransactionID", "TransactionDT"]
LOG_TRANSFORM_COLS = ["TransactionAmt"]
CATEGORICAL_COLS = [
    "ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain",
    "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9",
    "DeviceType", "DeviceInfo",
]
MISSING_CATEGORY = "missing"
NULL_THRESHOLD = 0.9
TIME_SOURCE = "TransactionDT"

ENCODER_SCHEMA = "column string, value string, code int"
BROADCAST_VALUES = 400_000                 # values of all broadcast encoders together
BROADCAST_CHARS = 16 * BROADCAST_VALUES    # and their code points


@dataclass
class FeatureModel:
    label: str
    feature_cols: list[str]
    dropped: list[str]
    unlisted_strings: list[str]
    log_transform_cols: list[str]
    categorical_cols: list[str]
    encoders: DataFrame                    # (column, value, code)
    means: dict[str, float]
    stds: dict[str, float]
    class_weight: float | None
    null_fill_value: float = NULL_FILL
    time_source: str | None = TIME_SOURCE
    extra: dict = field(default_factory=dict)

    # ── apply ────────────────────────────────────────────────────────────
    def transform(self, df: DataFrame, keep=(), scale: bool = True,
                  with_label: bool = True) -> DataFrame:
        """F7 apply: one projection producing ``keep`` + ``feature_cols`` (+
        label). Missing input columns are treated as all-NULL; a value that the
        fit did not see encodes as the fill value."""
        cats = [c for c in self.categorical_cols if c in self.feature_cols]
        cols = _pre_encode(df, self.time_source)
        coded = _join_codes(df, self.encoders, cats)
        out = []
        for c in self.feature_cols:
            if c in cats:
                x = F.col(f"_code_{c}").cast("double")
            else:
                x = cols.get(c, F.lit(None)).cast("double")
                if c in self.log_transform_cols:
                    x = F.log1p(x)
            x = F.nanvl(F.coalesce(x, F.lit(self.null_fill_value)), F.lit(self.null_fill_value))
            if scale:
                mu, sd = self.means[c], self.stds[c]
                x = F.lit(0.0) if sd == 0 else (x - F.lit(mu)) / F.lit(sd)
            out.append(x.alias(c))
        lab = [F.col(self.label)] if with_label and self.label in df.columns else []
        return coded.select(*[F.col(k) for k in keep], *out, *lab)

    # ── K5 / S9 persistence: small tables + one config row, no pickles ────
    def save(self, spark: SparkSession, path: str) -> None:
        self.encoders.write.mode("overwrite").parquet(os.path.join(path, "encoders"))
        stats = [(c, i, self.means[c], self.stds[c]) for i, c in enumerate(self.feature_cols)]
        spark.createDataFrame(stats, "column string, ord int, mean double, std double") \
            .write.mode("overwrite").parquet(os.path.join(path, "feature_stats"))
        cfg = {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("encoders", "means", "stds")}
        spark.createDataFrame([(json.dumps(cfg),)], "config string") \
            .write.mode("overwrite").json(os.path.join(path, "config"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        try:
            cfg = json.loads(spark.read.json(os.path.join(path, "config")).first()["config"])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(path) from None
        encoders = spark.read.schema(ENCODER_SCHEMA).parquet(os.path.join(path, "encoders"))
        stats = spark.read.parquet(os.path.join(path, "feature_stats")).orderBy("ord").collect()
        return FeatureModel(encoders=encoders, means={r["column"]: r["mean"] for r in stats},
                            stds={r["column"]: r["std"] for r in stats}, **cfg)

    def codes(self, column: str) -> DataFrame:
        """(value, code) of one categorical column."""
        return self.encoders.where(F.col("column") == column).select("value", "code")

    def metadata(self) -> dict:
        """Feature metadata in the reference's shape (FIXTURES §4), with the
        number of codes per column; the codes themselves are a table
        (``codes``), as a column may have any number."""
        counts = self.encoders.groupBy("column").count().collect()      # one row per column
        return {"feature_cols": list(self.feature_cols), "encoders": {r["column"]: r["count"] for r in counts},
                "log_transform_cols": list(self.log_transform_cols),
                "null_fill_value": self.null_fill_value, "class_weight": self.class_weight,
                "null_threshold": NULL_THRESHOLD}


def _pre_encode(df: DataFrame, time_source: str | None) -> dict:
    cols = {c: F.col(c) for c in df.columns}
    if time_source and time_source in df.columns:            # F1
        hod, dow = time_features(time_source)
        cols["hour_of_day"], cols["day_of_week"] = hod, dow
    return cols


def _join_codes(df: DataFrame, encoders: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``_code_<col>`` per column by an equi-join on the value (NULL →
    "missing"; an unseen value finds no row). One row per value on the right,
    so no row is repeated. A broadcast encoder is proven small by its count
    (``small_encoders``); in the join with a larger one a frequent value is a
    hot key, which AQE splits. Shuffled joins come last, on columns already
    encoded."""
    out = df
    small = small_encoders(encoders, cols)
    for c in sorted(cols, key=lambda c: c not in small):
        table = encoders.where(F.col("column") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_code_{c}"))
        if c in small:
            table = F.broadcast(table)
        value = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
        out = out.join(table, F.coalesce(value, F.lit(MISSING_CATEGORY)) == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    return out


def small_encoders(encoders: DataFrame, cols: list[str], values: int | None = None,
                   chars: int | None = None) -> set[str]:
    """The columns whose encoders may be broadcast together: smallest first,
    while their values and code points stay within the bounds. One aggregation
    of the encoder table, one row per column to the driver."""
    left, room = values or BROADCAST_VALUES, chars or BROADCAST_CHARS
    sizes = encoders.where(F.col("column").isin(cols)).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars")).collect() if cols else []
    small = set()
    for r in sorted(sizes, key=lambda r: (r["n"], r["chars"] or 0, r["column"])):
        left, room = left - r["n"], room - (r["chars"] or 0)
        if left < 0 or room < 0:
            break
        small.add(r["column"])
    return small


def time_feature_frame(df: DataFrame) -> DataFrame:
    """F1 as a frame: adds fractional ``hour_of_day`` / ``day_of_week``."""
    if TIME_SOURCE not in df.columns:
        return df
    hod, dow = time_features(TIME_SOURCE)
    return df.select("*", hod.alias("hour_of_day"), dow.alias("day_of_week"))


def fit_encoders(df: DataFrame, cols: list[str]) -> DataFrame:
    """F3 fit: (column, value, code) with codes 0… in code-point order of the
    distinct values (UTF-8 byte order = code-point order), NULL → "missing".
    One unpivot + distinct for all categorical columns; the values are
    numbered by a range-partitioned sequence per column, so a column with very
    many values is spread over tasks."""
    if not cols:
        return df.sparkSession.createDataFrame([], ENCODER_SCHEMA)
    long = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias(c)
                       for c in cols]).unpivot([], cols, "column", "value").distinct()
    numbered = sequence_number(long, ["value"], by=["column"], name="seq")
    return numbered.select("column", "value", (F.col("seq") - 1).cast("int").alias("code"))


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """F5 fit: (column, mean, std) with population std, one shuffle for all
    columns via unpivot."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "v")
    return long.groupBy("column").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def fit_features(df: DataFrame, label: str = LABEL, categorical=CATEGORICAL_COLS,
                 log_cols=LOG_TRANSFORM_COLS, drop_cols=DROP_COLS,
                 null_threshold: float = NULL_THRESHOLD, fill: float = NULL_FILL) -> FeatureModel:
    """F7 fit (F1 → A2 → F2 → F3 → F4 → F5, then A4)."""
    staged = time_feature_frame(df)
    candidates = [c for c in staged.columns if c != label]
    # A2: null rates of every column (one unpivot job), decision frozen here.
    too_null = high_null_columns(null_rates(staged, candidates), null_threshold)
    dropped = sorted(set(too_null) | {c for c in drop_cols if c in staged.columns})
    kept = [c for c in candidates if c not in set(dropped)]
    cats = [c for c in categorical if c in kept]
    numeric_types = (T.NumericType, T.BooleanType)
    unlisted = [c for c in kept if c not in cats
                and not isinstance(staged.schema[c].dataType, numeric_types)]
    feature_cols = [c for c in kept if c not in set(unlisted)]

    encoders = cut_lineage(fit_encoders(staged, cats))
    provisional = FeatureModel(label=label, feature_cols=feature_cols, dropped=dropped,
                               unlisted_strings=unlisted, log_transform_cols=[c for c in log_cols if c in kept],
                               categorical_cols=cats, encoders=encoders,
                               means={}, stds={}, class_weight=None, null_fill_value=fill)
    unscaled = provisional.transform(df, scale=False, with_label=False)
    stats = {r["column"]: (r["mean"], r["std"]) for r in fit_scaler(unscaled, feature_cols).collect()}
    weight = df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"),
                                 F.count_if(F.col(label) == 1).cast("double")).alias("w")).first()["w"]
    provisional.means = {c: float(stats[c][0]) if stats[c][0] is not None else 0.0 for c in feature_cols}
    provisional.stds = {c: float(stats[c][1]) if stats[c][1] is not None else 0.0 for c in feature_cols}
    provisional.class_weight = weight
    return provisional


def join_encoders(df: DataFrame, encoders: DataFrame, cols: list[str], fill: float = NULL_FILL) -> DataFrame:
    """J4 as an operator: the columns replaced by their codes; a value without
    a code becomes ``fill``."""
    coded = _join_codes(df, encoders, cols)
    return coded.select(*[
        F.coalesce(F.col(f"_code_{c}").cast("double"), F.lit(float(fill))).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def class_weight_column(label: str, weight: float, name: str = "weight"):
    """positives weighted by the class weight, negatives 1."""
    return F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias(name)
