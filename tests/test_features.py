"""Feature pipeline properties (ports of the reference's feature tests plus
edge cases)."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import TRADE, raw_transactions
from vigil.operators import features as feat
from vigil.operators import trades as trd


def codes(model, column):
    return {r["value"]: r["code"] for r in model.codes(column).collect()}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(raw_transactions())


@pytest.fixture(scope="module")
def model(raw):
    return feat.fit_features(raw)


def test_high_null_column_dropped(model):
    assert "sparse_note" in model.dropped
    assert "sparse_note" not in model.feature_cols


def test_useful_column_kept(model):
    assert "basket_weight" in model.feature_cols


def test_id_and_time_source_dropped(model):
    assert "TransactionID" not in model.feature_cols
    assert "TransactionDT" not in model.feature_cols


def test_time_features_ranges(raw):
    t = feat.time_feature_frame(raw).agg(F.min("hour_of_day"), F.max("hour_of_day"),
                                         F.min("day_of_week"), F.max("day_of_week")).first()
    assert 0 <= t[0] and t[1] < 24 and 0 <= t[2] and t[3] < 7


def test_time_features_fractional(spark):
    df = spark.createDataFrame([(5400,)], "TransactionDT long")
    r = feat.time_feature_frame(df).first()
    assert r["hour_of_day"] == pytest.approx(1.5)
    assert r["day_of_week"] == pytest.approx(5400 / 86400)


def test_log_transform_shrinks_and_non_negative(raw, model):
    out = model.transform(raw, scale=False)
    mx = out.agg(F.max("TransactionAmt"), F.min("TransactionAmt")).first()
    raw_max = raw.agg(F.max("TransactionAmt")).first()[0]
    assert mx[0] < raw_max and mx[1] >= 0


def test_encoders_are_integer_codes_in_code_point_order(model):
    assert codes(model, "ProductCD") == {"kiosk": 0, "phone": 1, "store": 2, "web": 3}
    assert codes(model, "card4") == {"blue": 0, "green": 1, "missing": 2}


def test_null_category_encoded_as_missing(raw, model):
    out = model.transform(raw, scale=False).where(F.col("card4") == codes(model, "card4")["missing"])
    assert out.count() == raw.where(F.col("card4").isNull()).count() > 0


def test_no_nulls_after_apply(raw, model):
    out = model.transform(raw)
    nulls = out.select([F.sum((F.col(c).isNull() | F.isnan(c)).cast("int")).alias(c)
                        for c in model.feature_cols]).first().asDict()
    assert all(v == 0 for v in nulls.values())


def test_fill_value_used_before_scaling(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (3.0, 0)], "x double, isFraud int")
    m = feat.fit_features(df, categorical=[], log_cols=[], drop_cols=[])
    vals = [r["x"] for r in m.transform(df, scale=False).collect()]
    assert -999.0 in vals


def test_scaling_population_std_and_constant_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (3.0, 5.0, 1)], "a double, c double, isFraud int")
    m = feat.fit_features(df, categorical=[], log_cols=[], drop_cols=[])
    assert m.stds["a"] == pytest.approx(1.0)          # population std of [1, 3]
    out = m.transform(df).collect()
    assert [r["a"] for r in out] == pytest.approx([-1.0, 1.0])
    assert all(r["c"] == 0.0 for r in out)


def test_class_weight_large_for_rare_positives(model):
    assert model.class_weight > 10


def test_unlisted_strings_excluded(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1)], "note string, x double, isFraud int")
    m = feat.fit_features(df, categorical=[], log_cols=[], drop_cols=[])
    assert m.unlisted_strings == ["note"] and m.feature_cols == ["x"]


def test_save_load_roundtrip(spark, model, raw, tmp_dir):
    model.save(spark, tmp_dir)
    back = feat.FeatureModel.load(spark, tmp_dir)
    assert back.feature_cols == model.feature_cols
    assert sorted(back.encoders.collect()) == sorted(model.encoders.collect())
    a = model.transform(raw, keep=["TransactionID"]).orderBy("TransactionID").collect()
    b = back.transform(raw, keep=["TransactionID"]).orderBy("TransactionID").collect()
    assert a == b


def test_load_missing_metadata_raises(spark):
    with pytest.raises(FileNotFoundError):
        feat.FeatureModel.load(spark, "/tmp/definitely-not-here-vigil")


def test_join_encoders_equals_inline(spark, raw, model):
    enc = feat.fit_encoders(raw, ["ProductCD", "card4"])
    joined = feat.join_encoders(raw.select("TransactionID", "ProductCD", "card4"), enc, ["ProductCD", "card4"])
    inline = model.transform(raw, keep=["TransactionID"], scale=False).select("TransactionID", "ProductCD", "card4")
    assert sorted(joined.collect()) == sorted(inline.collect())


def test_encoder_of_any_size(spark):
    """More values than any driver-side table should hold: every value keeps
    its own code through fit and apply, and an unseen one is filled."""
    n = 120_000
    df = spark.range(n).select(F.format_string("user-%07d", "id").alias("card6"), F.rand(1).alias("x"),
                               (F.col("id") % 9 == 0).cast("int").alias("isFraud"))
    m = feat.fit_features(df)
    assert m.metadata()["encoders"] == {"card6": n}
    out = m.transform(df.withColumn("id", F.substring("card6", 6, 7).cast("int")), keep=["id"], scale=False)
    assert out.where(F.col("card6") != F.col("id")).count() == 0 and out.count() == n
    new = spark.createDataFrame([("nobody", 0.5, 0)], "card6 string, x double, isFraud int")
    assert m.transform(new, scale=False).first()["card6"] == -999.0


# ── trade mapper (F8–F10, F13, P3) ───────────────────────────────────────────

FEATURES = ["TransactionAmt", "hour_of_day", "day_of_week", "card1"]


def _trade_df(spark, msgs):
    return spark.createDataFrame([(json.dumps(m) if isinstance(m, dict) else m,) for m in msgs], "value string")


def test_mapper_amount_time_and_fill(spark):
    p = trd.parse_trades(_trade_df(spark, [TRADE]))
    r = trd.map_trade(p, FEATURES).first()
    assert r["TransactionAmt"] == pytest.approx(math.log1p(1400.2))
    assert r["hour_of_day"] == 6 and r["day_of_week"] == 1       # a Tuesday (UTC)
    assert r["card1"] == -999.0
    assert r["_trade_id"] == "777" and r["_symbol"] == "ETHUSDT"


def test_mapper_second_example(spark):
    msg = dict(TRADE, p="65000.00", q="0.01500")
    r = trd.map_trade(trd.parse_trades(_trade_df(spark, [msg])), FEATURES).first()
    assert r["TransactionAmt"] == pytest.approx(math.log1p(975.0))


def test_mapper_missing_fields(spark):
    msg = {k: v for k, v in TRADE.items() if k not in ("p", "T")}
    r = trd.map_trade(trd.parse_trades(_trade_df(spark, [msg])), FEATURES).first()
    assert r["TransactionAmt"] == 0.0           # missing price counts as 0
    assert r["hour_of_day"] == 6                # falls back to E


def test_case_distinct_fields_parse(spark):
    msg = dict(TRADE, t=7, T=1704070800000)     # 01:00 UTC
    r = trd.map_trade(trd.parse_trades(_trade_df(spark, [msg])), FEATURES).first()
    assert r["trade_id"] == 7 and r["hour_of_day"] == 1


def test_bad_input_flags(spark):
    bad_q = dict(TRADE, q="abc")
    p = trd.parse_trades(_trade_df(spark, [TRADE, bad_q, '{"p": "1"', "not json"]))
    flags = [r["ok"] for r in p.select(trd.inputs_valid().alias("ok")).collect()]
    assert flags == [True, False, False, False]


def test_vector_length_and_type(spark):
    p = trd.map_trade(trd.parse_trades(_trade_df(spark, [TRADE])), FEATURES)
    v = trd.order_features(p, FEATURES + ["unknown_feature"]).first()["feature_vector"]
    assert len(v) == 5 and all(isinstance(x, float) for x in v) and v[-1] == -999.0


def test_publish_frame_keys_source_and_quarantine(spark):
    out, bad = trd.publish_frame(_trade_df(spark, [TRADE, dict(TRADE, s=None), "{broken"]))
    rows = out.collect()
    assert [bytes(r["key"]).decode() for r in rows] == ["ETHUSDT", "BTCUSDT"]
    doc = json.loads(rows[0]["value"])
    assert doc["source"] == "binance" and doc["t"] == 777 and doc["T"] == TRADE["T"]
    assert bad.count() == 1
