"""E11 validation of raw transactions: one aggregation, one row per check
``(check, passed, observed, limit)``. Raising on failure is the caller's
choice (:func:`raise_on_failure`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's validation.
REQUIRED_COLUMNS = ("TransactionID", "TransactionDT", "TransactionAmt", "isFraud")
MIN_ROWS_CODE = 100_000          # enforced in code: strictly more rows than this
MIN_ROWS_DOC = 1_000             # documented: at least this many rows
MIN_LABEL_RATE, MAX_LABEL_RATE = 0.001, 0.5   # documented 0.1 % … 50 %


def validate_transactions(df: DataFrame, label="isFraud", amount="TransactionAmt",
                          required=REQUIRED_COLUMNS, min_rows: int = MIN_ROWS_CODE) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    have_label, have_amount = label in df.columns, amount in df.columns
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_distinct(label) if have_label else F.lit(None)).cast("double").alias("n_labels"),
        (F.avg(F.col(label).cast("double")) if have_label else F.lit(None)).cast("double").alias("label_rate"),
        (F.min(F.col(amount).cast("double")) if have_amount else F.lit(None)).cast("double").alias("min_amount"))
    rows = F.col("rows").cast("double")
    checks = [
        ("required_columns", F.lit(len(missing) == 0), F.lit(float(len(missing))), F.lit(0.0)),
        ("binary_label", F.coalesce(F.col("n_labels") == 2, F.lit(False)), F.col("n_labels"), F.lit(2.0)),
        ("min_rows", rows > min_rows, rows, F.lit(float(min_rows))),
        ("min_rows_documented", rows >= MIN_ROWS_DOC, rows, F.lit(float(MIN_ROWS_DOC))),
        ("label_rate_low", F.coalesce(F.col("label_rate") >= MIN_LABEL_RATE, F.lit(False)),
         F.col("label_rate"), F.lit(MIN_LABEL_RATE)),
        ("label_rate_high", F.coalesce(F.col("label_rate") <= MAX_LABEL_RATE, F.lit(False)),
         F.col("label_rate"), F.lit(MAX_LABEL_RATE)),
        ("amount_non_negative", F.coalesce(F.col("min_amount") >= 0, F.lit(True)),
         F.col("min_amount"), F.lit(0.0)),
    ]
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), p.alias("passed"), o.cast("double").alias("observed"),
                 lim.cast("double").alias("limit"))
        for n, p, o, lim in checks])))


def raise_on_failure(report: DataFrame) -> None:
    failed = [r["check"] for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"validation failed: {failed}")
