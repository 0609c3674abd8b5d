"""Training, scoring and model bookkeeping.

The boosted-tree fit is Spark ML's ``GBTClassifier`` (distributed per-level
histogram aggregation); scoring is ``PipelineModel.transform`` inside the
executors — a narrow projection, so batch and streaming scoring share one
plan. Known differences to the reference's library (SURVEY §7.4): no
second-order leaf regularisation, per-node column sampling, impurity-based
importances, and built-in early stopping is "first insufficient gain"
(``validationTol``) rather than a patience window.
"""

from __future__ import annotations

import json
import os
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.scalars import FAILED_SCORE, NULL_FILL
from vigil.operators import trees
from vigil.operators.features import class_weight_column

# Fixed values of the reference's training job.
GBT_PARAMS = dict(maxDepth=6, stepSize=0.1, maxIter=200, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)
MODEL_TYPE = "gbt_classifier"
DEFAULT_THRESHOLD = 0.5


@contextmanager
def _reduce_width(spark: SparkSession, n: int | None):
    """At most ``n`` partitions for shuffles that name no width, while inside;
    a width that the deployment has set stays."""
    name, conf = "spark.default.parallelism", spark.sparkContext._jsc.sc().conf()
    if n is None or conf.contains(name):
        yield
        return
    conf.set(name, str(n))
    try:
        yield
    finally:
        conf.remove(name)


def train_classifier(train: DataFrame, feature_cols: list[str], label: str = "isFraud",
                     class_weight: float | None = None, validation_col: str | None = None,
                     reducers: int | None = None, **overrides) -> PipelineModel:
    """Assemble the feature columns (training order = vector order) and
    fit boosted trees; positives carry ``class_weight`` (F6) when given.
    ``validation_col`` (boolean) enables Spark's validation-based stopping.

    Each level of a tree merges the histograms of its few nodes (32 at depth 6)
    by a shuffle that Spark makes as wide as the matrix; ``reducers`` names its
    width instead, so that a level does not send one more, mostly empty, task
    result per matrix partition to the driver. It does not touch the layout of
    ``train``, which decides the row sampling, provided that is no file scan
    (a scan's splits follow the same setting)."""
    params = {**GBT_PARAMS, **overrides}
    cols = list(feature_cols)
    data = train.select(*cols, F.col(label).cast("double").alias(label),
                        *([class_weight_column(label, class_weight, "weight")] if class_weight else []),
                        *([F.col(validation_col)] if validation_col else []))
    gbt = GBTClassifier(featuresCol="features", labelCol=label, checkpointInterval=10, **params)
    if class_weight:
        gbt = gbt.setWeightCol("weight")
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    asm = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    with _reduce_width(train.sparkSession, reducers):
        return Pipeline(stages=[asm, gbt]).fit(data)


@dataclass(frozen=True)
class LinearScorer:
    """A logistic model with given coefficients (a rule agreed by hand, or a
    model fitted elsewhere); scores like a fitted pipeline."""
    coefficients: dict[str, float]
    intercept: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        z = F.lit(float(self.intercept))
        for name, weight in self.coefficients.items():
            z = z + F.lit(float(weight)) * F.col(name)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))


def score(model, df: DataFrame, score_col: str = "fraud_score",
          valid=None) -> DataFrame:
    """Positive-class probability; rows flagged invalid (inputs that did
    not parse) get −1.0, the reference's failed-call score."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability")).getItem(1)
    if valid is not None:
        p = F.when(valid, p).otherwise(F.lit(FAILED_SCORE))
    keep = [c for c in df.columns]
    return out.select(*keep, p.alias(score_col))


def save_model(spark: SparkSession, model: PipelineModel, path: str, feature_cols: list[str],
               auc: float | None, threshold: float = DEFAULT_THRESHOLD,
               scale_pos_weight: float | None = None) -> None:
    """Spark ML writer for the fitted stages, their node table, and one
    metadata row."""
    model.write().overwrite().save(os.path.join(path, "model"))
    trees.save_trees(trees.read_saved_trees(spark, os.path.join(path, "model"), list(feature_cols)), os.path.join(path, "trees"))
    meta = {"auc": auc, "feature_cols": list(feature_cols), "threshold": threshold,
            "model_type": MODEL_TYPE, "scale_pos_weight": scale_pos_weight}
    spark.createDataFrame([(json.dumps(meta),)], "metadata string") \
        .write.mode("overwrite").json(os.path.join(path, "metadata"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(os.path.join(path, "model"))
    meta = json.loads(spark.read.json(os.path.join(path, "metadata")).collect()[0]["metadata"])
    return model, meta


def load_tree_model(spark: SparkSession, path: str) -> tuple[trees.TreeModel, dict]:
    """The saved model from its node table alone."""
    meta = json.loads(spark.read.json(os.path.join(path, "metadata")).collect()[0]["metadata"])
    return trees.TreeModel.of(trees.load_trees(spark, os.path.join(path, "trees")), meta["feature_cols"]), meta


def feature_importance(spark: SparkSession, model: PipelineModel, feature_cols: list[str],
                       k: int = 10) -> DataFrame:
    """Top-k importances with names (bounded by the number of features)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    imp += [0.0] * (len(feature_cols) - len(imp))       # a cut model's vector ends with the last feature asked
    rows = [(c, float(v)) for c, v in zip(feature_cols, imp)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), F.asc("feature")).limit(k))


def top_deviations(df: DataFrame, feature_cols: list[str], k: int = 5,
                   means: dict | None = None, stds: dict | None = None,
                   name: str = "top_deviations", fill: float = NULL_FILL, values: str | None = None) -> DataFrame:
    """Per row, the k features furthest from the training mean in standard
    deviations, of unscaled values (``values`` names a struct that holds them,
    else the columns do). A feature that was filled or never varied in training
    says nothing about the row and is left out, so fewer than k may remain.
    Per-row array work, no shuffle."""
    items = []
    for c in feature_cols:
        x = (F.col(f"{values}.{c}") if values else F.col(c)).cast("double")
        dev = F.abs(x) if means is None else \
            F.abs(F.try_divide(x - F.lit(means[c]), F.lit(stds[c] or None)))
        items.append(F.struct(F.when(x != F.lit(float(fill)), dev).alias("deviation"),
                              F.lit(c).alias("feature"), x.alias("value")))
    told = F.filter(F.array(*items), lambda i: i["deviation"].isNotNull())
    return df.withColumn(name, F.slice(F.sort_array(told, asc=False), 1, k))


def evaluation_row(spark: SparkSession, auc: float | None, metrics: list[dict],
                   recommended: float | None, n_test: int, model_type: str = MODEL_TYPE,
                   evaluated_at: str | None = None) -> DataFrame:
    """E10 tail: one report row (K7 appends it to the reports table)."""
    return spark.createDataFrame(
        [("evaluation", evaluated_at, auc, recommended, int(n_test), json.dumps(metrics), model_type)],
        "kind string, evaluated_at string, auc double, recommended_threshold double, "
        "n_test bigint, threshold_metrics string, model_type string")


def retrain_history(reports: DataFrame, n: int = 20) -> DataFrame:
    """The latest ``n`` retraining reports, oldest first; missing
    ``triggered_by`` reads as "manual"."""
    latest = reports.orderBy(F.desc("completed_at")).limit(n)
    cols = [F.coalesce(F.col("triggered_by"), F.lit("manual")).alias("triggered_by")
            if c == "triggered_by" else F.col(c) for c in reports.columns]
    return latest.select(*cols).orderBy("completed_at")


def current_model(metrics: DataFrame, key=(), ts_col: str = "deployed_at") -> DataFrame:
    """T4: the latest metrics row (per key) — ``max_by`` on the timestamp, a
    grouped aggregation instead of a sort."""
    fields = [c for c in metrics.columns if c not in key]
    latest = F.max_by(F.struct(*fields), F.col(ts_col)).alias("_latest")
    return metrics.groupBy(*key).agg(latest).select(*key, "_latest.*")


PATIENCE = 20   # rounds without validation-AUC improvement before the reference stops


def prefix_auc(model: PipelineModel, valid: DataFrame, label: str = "isFraud") -> list[tuple[int, float | None]]:
    """Exact validation AUC after every boosting round (AUC is rank-based, so
    margins stand in for probabilities)."""
    curve = trees.ValidationCurve(trees.model_of(model, model.stages[0].getInputCols()), valid, label)
    return sorted(curve.exact(curve.rounds).items())


def validation_stop(model: PipelineModel, valid: DataFrame, label: str, patience: int) -> dict:
    """:func:`patience_stop` of the validation curve, of which only the rounds
    that decide the best one are counted exactly."""
    curve = trees.ValidationCurve(trees.model_of(model, model.stages[0].getInputCols()), valid, label)
    return patience_stop(curve.settled(), patience)


def patience_stop(aucs: list[tuple[int, float]], patience: int = PATIENCE) -> dict:
    """Best round (first maximum) and the round at which a patience rule
    would have stopped; ``aucs`` is a (round, auc) list (one entry per round,
    bounded by maxIter)."""
    best_k, best, stopped = None, None, None
    for k, a in aucs:
        if a is not None and (best is None or a > best):
            best_k, best = k, a
        if best_k is not None and k - best_k >= patience:
            stopped = k
            break
    return {"best_iteration": best_k, "best_val_auc": best, "early": stopped is not None,
            "stopped_at": stopped if stopped is not None else (aucs[-1][0] if aucs else None)}


def train_with_patience(train: DataFrame, valid: DataFrame, feature_cols: list[str],
                        label: str = "isFraud", class_weight: float | None = None,
                        patience: int = PATIENCE, reducers: int | None = None,
                        **overrides) -> tuple[PipelineModel, dict]:
    """E6 with the reference's early stopping: stop once the validation AUC
    has not improved for ``patience`` rounds, keeping every tree up to that
    round (at most ``maxIter``).

    Spark's GBT has no warm start, but tree m depends only on (data, seed, m),
    so a shorter fit is an exact prefix of a longer one. The first fit has
    patience + 1 rounds (the fewest in which the rule can fire). If its AUC has
    been flat for a quarter of the patience, the next fit ends exactly at the
    round where the rule fires unless the AUC improves again (best + patience).
    Else one fit of all ``maxIter`` rounds follows and is cut at the stop round
    (:func:`first_rounds`). So beside ``maxIter`` rounds at most the two short
    fits' (3 * patience) are fitted, wherever the rule fires."""
    max_iter = {**GBT_PARAMS, **overrides}["maxIter"]
    first = n = min(max_iter, patience + 1)
    while True:
        model = train_classifier(train, feature_cols, label, class_weight, reducers=reducers,
                                 **{**overrides, "maxIter": n})
        stop = validation_stop(model, valid, label, patience)
        if stop["early"] or n >= max_iter:
            break
        best = stop["best_iteration"]
        if n == first and best is not None and n - best >= max(1, patience // 4):
            n = min(max_iter, best + patience)
        else:
            n = max_iter
    return first_rounds(model, stop["stopped_at"]), stop


def first_rounds(model: PipelineModel, n: int) -> PipelineModel:
    """The fitted pipeline with the first ``n`` of its trees: what a fit of
    ``n`` rounds gives. Built by the model's public constructor from trees and
    weights, which knows the features by the splits alone."""
    *before, gbt = model.stages
    if n >= gbt.getNumTrees:
        return model
    sc = SparkSession.active().sparkContext
    jvm, fitted = sc._jvm, gbt._java_obj
    kept = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(jvm.double, n)
    for i, (tree, weight) in enumerate(zip(fitted.trees()[:n], fitted.treeWeights()[:n])):
        kept[i], weights[i] = tree, weight
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(gbt.uid, kept, weights))
    gbt._copyValues(cut, {gbt.maxIter: n})
    cut._transfer_params_to_java()
    return PipelineModel([*before, cut])
