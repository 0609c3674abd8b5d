"""Training, scoring and bookkeeping (ports of the reference's training tests;
≤ 10 trees to keep them fast)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import feature_matrix
from vigil.operators import evaluate as ev
from vigil.operators import joins, train

FEATURES = ["TransactionAmt", "hour_of_day", "day_of_week", "card1", "card2"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(feature_matrix(200, separable=True)).withColumn("id", F.monotonically_increasing_id())
    return ev.stratified_split(df, "isFraud", ["id"])


@pytest.fixture(scope="module")
def fitted(data):
    return train.train_classifier(data.where(~F.col("is_test")), FEATURES, "isFraud",
                                  class_weight=27.6, maxIter=10)


def test_split_keeps_positives_on_both_sides(data):
    c = {r["is_test"]: r["p"] for r in data.groupBy("is_test").agg(F.sum("isFraud").alias("p")).collect()}
    assert c[True] >= 1 and c[False] >= 1


def test_label_not_a_feature(fitted):
    assert fitted.stages[0].getInputCols() == FEATURES


def test_probabilities_in_unit_interval_and_auc(fitted, data):
    scored = train.score(fitted, data.where(F.col("is_test")))
    mm = scored.agg(F.min("fraud_score"), F.max("fraud_score")).first()
    assert 0.0 <= mm[0] <= mm[1] <= 1.0
    assert ev.roc_auc(scored, "isFraud", "fraud_score").first()["auc"] > 0.5


def test_invalid_rows_score_minus_one(fitted, data):
    scored = train.score(fitted, data, valid=F.col("id") % 2 == 0)
    bad = scored.where(F.col("id") % 2 == 1).agg(F.max("fraud_score")).first()[0]
    assert bad == -1.0


def test_save_load_same_scores(spark, fitted, data, tmp_dir):
    train.save_model(spark, fitted, tmp_dir, FEATURES, auc=0.9, scale_pos_weight=27.6)
    back, meta = train.load_model(spark, tmp_dir)
    a = [round(r[0], 5) for r in train.score(fitted, data).orderBy("id").select("fraud_score").collect()]
    b = [round(r[0], 5) for r in train.score(back, data).orderBy("id").select("fraud_score").collect()]
    assert a == b
    assert set(meta) == {"auc", "feature_cols", "threshold", "model_type", "scale_pos_weight"}
    assert meta["feature_cols"] == FEATURES


def test_importance_top_k(spark, fitted):
    imp = train.feature_importance(spark, fitted, FEATURES, 3).collect()
    assert len(imp) == 3 and imp[0]["feature"] == "TransactionAmt"


def test_top_deviations(spark):
    df = spark.createDataFrame([(0.1, -3.0, 2.0)], "a double, b double, c double")
    r = train.top_deviations(df, ["a", "b", "c"], 2).first()["top_deviations"]
    assert [x["feature"] for x in r] == ["b", "c"]


def test_validation_stopping_option(data):
    d = data.withColumn("is_val", F.col("id") % 5 == 0)
    m = train.train_classifier(d.where(~F.col("is_test")), FEATURES, "isFraud",
                               validation_col="is_val", maxIter=10)
    assert 1 <= m.stages[-1].getNumTrees <= 10


def test_promotion_gate(spark):
    cand = spark.createDataFrame([("m", 0.91), ("n", 0.80), ("o", None)], "model_name string, auc double")
    cur = spark.createDataFrame([("m", 0.90, dt.datetime(2024, 1, 1)), ("m", 0.904, dt.datetime(2024, 1, 2)),
                                 ("n", 0.70, dt.datetime(2024, 1, 1))],
                                "model_name string, auc double, deployed_at timestamp")
    latest = train.current_model(cur, key=["model_name"])
    got = {r["model_name"]: (r["deploy"], r["reason"]) for r in joins.compare_models(cand, latest).collect()}
    assert got["m"] == (True, "deploy")          # 0.91 - 0.904 = 0.006 >= 0.005
    assert got["n"] == (True, "deploy")
    assert got["o"] == (False, "skip_no_auc")
    first = joins.compare_models(cand.limit(1), latest.limit(0)).first()
    assert first["reason"] == "first_deployment"


def test_retrain_history_latest_first_then_ascending(spark):
    rows = [(f"2024-01-{d:02d}", None if d % 2 else "drift") for d in range(1, 26)]
    rep = spark.createDataFrame(rows, "completed_at string, triggered_by string")
    out = train.retrain_history(rep, 20).collect()
    assert len(out) == 20 and out[0]["completed_at"] == "2024-01-06"
    assert out[-1]["completed_at"] == "2024-01-25" and out[0]["triggered_by"] == "drift"
    assert out[1]["triggered_by"] == "manual"


def test_prefix_auc_of_every_round(fitted, data):
    valid = data.where(F.col("is_test"))
    per_round = dict(train.prefix_auc(fitted, valid, "isFraud"))
    assert sorted(per_round) == list(range(1, 11))
    cur = fitted.stages[0].transform(valid)
    margin = F.lit(0.0)
    for k, (tree, w) in enumerate(zip(fitted.stages[-1].trees, fitted.stages[-1].treeWeights), 1):
        cur = tree.copy().setPredictionCol(f"t{k}").transform(cur)
        margin = margin + F.lit(float(w)) * F.col(f"t{k}")
        want = ev.roc_auc(cur.select("isFraud", margin.alias("m")), "isFraud", "m").first()["auc"]
        assert per_round[k] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("bins", [2, 64, 1 << 14])
def test_curve_of_any_width_settles_on_the_same_best_round(fitted, data, bins):
    valid = data.where(F.col("is_test"))
    exact = train.prefix_auc(fitted, valid, "isFraud")
    curve = train.trees.ValidationCurve(train.trees.model_of(fitted, FEATURES), valid, "isFraud", bins)
    for k, a in exact:
        low, high = curve.bounds(k)
        assert low - 1e-12 <= a <= high + 1e-12
    for patience in (2, 4, 20):
        assert train.patience_stop(curve.settled(), patience) == train.patience_stop(exact, patience)


def test_no_exchange_carries_rows_times_rounds(fitted, data):
    curve = train.trees.ValidationCurve(train.trees.model_of(fitted, FEATURES), data, "isFraud", 8)
    assert curve._histogram().count() <= 10 * 8


def test_tree_table_scores_like_the_model(spark, fitted, data, tmp_dir):
    train.save_model(spark, fitted, tmp_dir, FEATURES, auc=0.9)
    holes = data.withColumn("card1", F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("card1")))
    loaded, meta = train.load_tree_model(spark, tmp_dir)
    for model in (loaded, train.trees.model_of(fitted, FEATURES)):
        a = train.score(model, holes).orderBy("id").collect()
        b = train.score(fitted, holes).orderBy("id").collect()
        assert [r["fraud_score"] for r in a] == pytest.approx([r["fraud_score"] for r in b], abs=1e-12)
    assert meta["auc"] == 0.9


def test_importance_of_the_table_is_the_models(spark, fitted, tmp_dir):
    train.save_model(spark, fitted, tmp_dir, FEATURES, auc=None)
    got = {r["feature"]: r["importance"] for r in
           train.trees.importance(train.trees.load_trees(spark, tmp_dir + "/trees")).collect()}
    want = dict(zip(FEATURES, fitted.stages[-1].featureImportances.toArray()))
    assert {f: got.get(f, 0.0) for f in FEATURES} == pytest.approx(want, abs=1e-9)


def test_layout_follows_the_rows():
    from vigil.plans import training
    assert training.matrix_layout(10) == 16 and training.matrix_layout(100_000_001) == 401


def test_patience_stop():
    aucs = [(k, 0.5 + 0.01 * min(k, 5)) for k in range(1, 40)]
    assert train.patience_stop(aucs, 20) == {"best_iteration": 5, "best_val_auc": pytest.approx(0.55),
                                             "stopped_at": 25, "early": True}
    assert train.patience_stop([(1, 0.6), (2, 0.7)], 20)["stopped_at"] == 2


def test_train_with_patience_stops_and_keeps_prefix(data):
    tr_, va = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    model, stop = train.train_with_patience(tr_, va, FEATURES, "isFraud", patience=3, maxIter=12)
    assert model.stages[-1].getNumTrees == stop["stopped_at"] <= 12
    if stop["early"]:
        assert stop["stopped_at"] - stop["best_iteration"] == 3


def test_no_round_is_fitted_again_when_the_rule_fires_late(spark, data, monkeypatch, tmp_dir):
    """The AUC rises past the first fit and the rule fires at round 9 of 12: one
    more fit, cut to what a fit of nine rounds gives."""
    rounds, fit = [], train.train_classifier

    def counted(*args, **options):
        rounds.append(options["maxIter"])
        return fit(*args, **options)

    def stop(model, *_):
        n = model.stages[-1].getNumTrees
        return {"best_iteration": min(n, 6), "best_val_auc": 0.9, "early": n >= 9, "stopped_at": min(n, 9)}

    monkeypatch.setattr(train, "train_classifier", counted)
    monkeypatch.setattr(train, "validation_stop", stop)
    got, _ = train.train_with_patience(data, data, FEATURES, "isFraud", 27.6, patience=3, maxIter=12)
    assert rounds == [4, 12]
    want = fit(data, FEATURES, "isFraud", 27.6, maxIter=9)
    assert got.stages[-1].getNumTrees == got.stages[-1].getMaxIter() == 9
    scores = lambda m: [r["fraud_score"] for r in train.score(m, data).orderBy("id").collect()]
    assert scores(got) == scores(want)
    importance = lambda m: train.feature_importance(spark, m, FEATURES).collect()
    assert importance(got) == importance(want)
    train.save_model(spark, got, tmp_dir, FEATURES, auc=None)
    assert scores(train.load_model(spark, tmp_dir)[0]) == scores(want)


def test_cut_model_tells_features_that_no_tree_asks(spark, data):
    padded = data.withColumn("never", F.lit(0.0))
    got = train.first_rounds(train.train_classifier(padded, [*FEATURES, "never"], "isFraud", maxIter=3), 2)
    told = {r["feature"]: r["importance"] for r in train.feature_importance(spark, got, [*FEATURES, "never"]).collect()}
    assert got.stages[-1].getNumTrees == 2 and set(told) == {*FEATURES, "never"} and told["never"] == 0.0


def test_curve_sends_its_bins_from_few_tasks(spark, fitted, data):
    """A task sends rounds x bins, however few rows it has."""
    valid = data.where(F.col("is_test"))
    curve = train.trees.ValidationCurve(train.trees.model_of(fitted, FEATURES), valid.repartition(100), "isFraud")
    assert curve._rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert curve.exact(curve.rounds) == dict(train.prefix_auc(fitted, valid, "isFraud"))


def test_a_level_merges_its_nodes_in_few_tasks(spark, tmp_dir, monkeypatch):
    """The shuffle of a level is not as wide as the matrix, and the trees are
    those of the wide one. The joined rows are made once."""
    from vigil.plans import training
    made = spark.sparkContext.accumulator(0)
    joined = training.tables.transactions

    def told(parts):
        for part in parts:
            made.add(len(part))
            yield part

    monkeypatch.setattr(training.tables, "transactions", lambda *a: (lambda df: df.mapInPandas(told, df.schema))(joined(*a)))
    day = dt.date(2024, 1, 1)
    (spark.createDataFrame([(i, day + dt.timedelta(days=i % 300), float(i * 37 % 1000), f"{i % 5}-P", i % 50, "P" if i % 9 == 0 else "O")
                            for i in range(900)], "o_orderkey long, o_orderdate date, o_totalprice double, "
                           "o_orderpriority string, o_custkey long, o_orderstatus string")
     .write.parquet(f"{tmp_dir}/orders.parquet"))
    (spark.createDataFrame([(i, f"S{i % 4}", i % 25, float(i * 13 % 90)) for i in range(50)],
                           "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double")
     .write.parquet(f"{tmp_dir}/customer.parquet"))
    sc, layout = spark.sparkContext, training.MATRIX_PARTITIONS + 8
    sc.setJobGroup("few-merges", "fit")
    try:
        run = training.training_run(spark, tmp_dir, layout=layout, early_stopping=False, maxIter=2, maxDepth=2)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    told = sc.statusTracker()
    stages = [told.getStageInfo(i) for j in told.getJobIdsForGroup("few-merges") for i in told.getJobInfo(j).stageIds]
    merges = [i.numTasks for i in stages if i is not None and i.name.startswith("collectAsMap at RandomForest")]
    assert len(merges) >= 2 and max(merges) <= training.MATRIX_PARTITIONS
    assert run.matrix.rdd.getNumPartitions() == layout and made.value == 900
    wide = train.train_classifier(run.matrix.where(~F.col("is_test")), run.features.feature_cols, "isFraud",
                                  class_weight=run.features.class_weight, maxIter=2, maxDepth=2)
    tree = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    assert tree(run.model) == tree(wide)
