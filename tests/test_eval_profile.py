"""Evaluation and profiling against brute force (numpy/pandas) and edge tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtures import raw_transactions
from vigil.operators import evaluate as ev
from vigil.operators import profile


def brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l != 1]
    if not pos or not neg:
        return None
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def _scores(spark, labels, scores):
    return spark.createDataFrame([(int(l), float(s)) for l, s in zip(labels, scores)], "label int, score double")


def test_auc_with_ties_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    labels = rng.integers(0, 2, 300)
    scores = np.round(rng.random(300) * 0.5 + labels * 0.2, 1)      # heavy ties
    got = ev.roc_auc(_scores(spark, labels, scores)).first()
    assert got["auc"] == pytest.approx(brute_auc(labels, scores), rel=1e-12)


@pytest.mark.parametrize("labels,scores,expect", [
    ([1, 1, 1], [0.1, 0.2, 0.3], None),           # one class
    ([0, 1, 0, 1], [0.5] * 4, 0.5),                # all equal
    ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9], 1.0),     # perfect
    ([0, 0, 1, 1], [0.9, 0.8, 0.2, 0.1], 0.0),
])
def test_auc_edges(spark, labels, scores, expect):
    got = ev.roc_auc(_scores(spark, labels, scores)).first()["auc"]
    assert got == expect


def test_auc_grouped(spark):
    rows = [("a", 0, 0.1), ("a", 1, 0.9), ("b", 0, 0.9), ("b", 1, 0.1), ("b", 1, 0.95)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r["auc"] for r in ev.roc_auc(df, by=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.5}


def test_threshold_metrics_brute_force(spark):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 200)
    scores = rng.random(200)
    rows = {r["threshold"]: r for r in ev.threshold_metrics(_scores(spark, labels, scores)).collect()}
    for t in ev.THRESHOLDS:
        pred = scores >= t
        tp = int(((labels == 1) & pred).sum()); fp = int(((labels == 0) & pred).sum())
        fn = int(((labels == 1) & ~pred).sum()); tn = int(((labels == 0) & ~pred).sum())
        p = tp / (tp + fp) if tp + fp else 0.0
        r = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * p * r / (p + r) if p + r else 0.0
        g = rows[t]
        assert (g["tp"], g["fp"], g["fn"], g["tn"]) == (tp, fp, fn, tn)
        assert g["precision"] == pytest.approx(round(p, 4)) and g["recall"] == pytest.approx(round(r, 4))
        assert g["f1"] == pytest.approx(round(f1, 4)) and g["flagged"] == tp + fp and g["missed"] == fn


def test_threshold_metrics_nobody_flagged(spark):
    g = ev.threshold_metrics(_scores(spark, [0, 1], [0.1, 0.2]), thresholds=[0.9]).first()
    assert g["precision"] == 0.0 and g["recall"] == 0.0 and g["f1"] == 0.0 and g["flagged"] == 0


def test_recommend_threshold(spark):
    m = spark.createDataFrame(
        [(0.3, 0.14, 0.94), (0.4, 0.20, 0.90), (0.5, 0.27, 0.86), (0.6, 0.37, 0.69), (0.7, 0.37, 0.5)],
        "threshold double, precision double, recall double")
    assert ev.recommend_threshold(m).first()["threshold"] == 0.5
    low = m.withColumn("recall", F.col("recall") / 2)
    r = ev.recommend_threshold(low).first()
    assert r["threshold"] == 0.3 and not r["meets_min_recall"]


def test_confusion_and_report(spark):
    labels = [0, 0, 0, 1, 1, 1, 1, 0]
    scores = [0.1, 0.6, 0.2, 0.7, 0.8, 0.3, 0.9, 0.4]
    cm = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(_scores(spark, labels, scores)).collect()}
    assert cm == {(0, 0): 3, (0, 1): 1, (1, 0): 1, (1, 1): 3}
    rep = {r["class"]: r for r in ev.classification_report(_scores(spark, labels, scores)).collect()}
    assert rep["1"]["precision"] == 0.75 and rep["1"]["support"] == 4
    assert rep["accuracy"]["f1"] == 0.75 and rep["accuracy"]["precision"] is None
    assert rep["macro avg"]["recall"] == 0.75 and rep["weighted avg"]["support"] == 8


def test_stratified_split_exact_and_deterministic(spark):
    pdf = raw_transactions(1000)
    df = spark.createDataFrame(pdf)
    s1 = ev.stratified_split(df, "isFraud", ["TransactionID"])
    counts = {(r["isFraud"], r["is_test"]): r["count"] for r in s1.groupBy("isFraud", "is_test").count().collect()}
    n_pos = int(pdf.isFraud.sum())
    assert counts[(1, True)] == math.floor(0.2 * n_pos + 0.5) and counts[(1, False)] > 0
    assert counts[(0, True)] == math.floor(0.2 * (1000 - n_pos) + 0.5)
    ids1 = sorted(r[0] for r in s1.where("is_test").select("TransactionID").collect())
    ids2 = sorted(r[0] for r in ev.stratified_split(df, "isFraud", ["TransactionID"]).where("is_test")
                  .select("TransactionID").collect())
    assert ids1 == ids2


# ── profiling ────────────────────────────────────────────────────────────────

def test_null_rates_count_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    got = {r["column"]: r["null_rate"] for r in profile.null_rates(df).collect()}
    assert got == {"x": 0.5, "s": 0.25}


def test_quantile_buckets_match_pandas_qcut(spark):
    pdf = raw_transactions(1000)
    df = spark.createDataFrame(pdf)
    got = {r["bucket"]: (r["n"], r["label_rate"]) for r in
           profile.label_rate_by_quantile(df, "TransactionAmt", "isFraud", 10).collect()}
    cats = pd.qcut(pdf["TransactionAmt"], 10, labels=False, duplicates="drop")
    exp = pdf.groupby(cats)["isFraud"].agg(["count", "mean"])
    assert {int(k) + 1: (int(v["count"]), pytest.approx(v["mean"])) for k, v in exp.iterrows()} == got


def test_exact_median_matches_numpy(spark):
    pdf = raw_transactions(999)
    df = spark.createDataFrame(pdf)
    r = profile.describe(df, "TransactionAmt").first()
    assert r["median"] == pytest.approx(float(np.median(pdf.TransactionAmt)))
    assert r["min"] == pytest.approx(pdf.TransactionAmt.min())


def test_histogram_matches_numpy(spark):
    pdf = raw_transactions(1000)
    df = spark.createDataFrame(pdf)
    for log in (False, True):
        vals = np.log1p(pdf.TransactionAmt) if log else pdf.TransactionAmt
        counts, _ = np.histogram(vals, 100)
        got = [r["n"] for r in profile.histogram(df, "TransactionAmt", 100, log=log).orderBy("bin").collect()]
        assert got == counts.tolist()


def test_label_correlation_matches_pandas(spark):
    pdf = raw_transactions(1000)
    pdf["const"] = 1.0
    df = spark.createDataFrame(pdf.drop(columns=["ProductCD", "card4"]))
    got = {r["column"]: r["corr"] for r in profile.label_correlation(df, "isFraud").collect()}
    exp = pdf.drop(columns=["ProductCD", "card4"]).corr()["isFraud"].drop("isFraud")
    for c, v in exp.items():
        if np.isnan(v):
            assert got[c] is None
        else:
            assert got[c] == pytest.approx(v, abs=1e-9)


def test_class_balance_and_weight(spark):
    df = spark.createDataFrame([(0,)] * 27 + [(1,)] * 1, "y int")
    bal = {r["label"]: r for r in profile.class_balance(df, "y").collect()}
    assert bal[1]["n"] == 1 and bal[0]["neg_per_pos"] == 27
    assert profile.class_weight(df, "y").first()[0] == 27.0
    none = spark.createDataFrame([(0,)] * 3, "y int")
    assert profile.class_weight(none, "y").first()[0] is None
    assert profile.distinct_label_check(none, "y").first()["passed"] is False
