"""Joins (J1, J4, J5, J6).

No join hint is forced on data-sized inputs: Catalyst and AQE choose
broadcast or sort-merge from runtime sizes (and split skewed partitions).
Explicit broadcasts only appear on sides whose size is bounded by
construction (encoder tables: one row per distinct category value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def merge_identity(transactions: DataFrame, identity: DataFrame, key="TransactionID",
                   check_unique: bool = True) -> DataFrame:
    """Left equi-join; the row count is unchanged iff the right key is
    unique, which is checked directly (a grouped count that must be empty)
    rather than by counting both sides of the join."""
    if check_unique and duplicate_keys(identity, key).limit(1).count() > 0:
        raise DuplicateKeyError(f"right-side key {key!r} is not unique")
    return transactions.join(identity, key, "left")


def missing_keys(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Left rows without a match (anti join)."""
    return left.join(right.select(key), key, "left_anti")


def matched_keys(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Left rows with a match (semi join)."""
    return left.join(right.select(key), key, "left_semi")


def compare_models(candidate: DataFrame, current: DataFrame, key: str | list[str] = "model_name",
                   min_improvement: float = 0.005) -> DataFrame:
    """J5 + E9 promotion gate: deploy when there is no current model, or the
    candidate AUC improves on it by at least ``min_improvement``; a NULL
    candidate AUC never deploys (no 0.0 default)."""
    keys = [key] if isinstance(key, str) else list(key)
    cur = current.select(*keys, F.col("auc").alias("current_auc"))
    j = candidate.join(cur, keys, "left")
    improvement = F.col("auc") - F.col("current_auc")
    deploy = (F.when(F.col("auc").isNull(), False)
              .when(F.col("current_auc").isNull(), True)
              .otherwise(improvement >= F.lit(min_improvement)))
    return j.select("*", improvement.alias("improvement"), deploy.alias("deploy"),
                    F.when(F.col("auc").isNull(), "skip_no_auc")
                    .when(F.col("current_auc").isNull(), "first_deployment")
                    .when(deploy, "deploy").otherwise("keep_current").alias("reason"))
