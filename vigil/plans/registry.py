"""Query registry: name → Spark callable ``(spark, sf_dir) -> DataFrame`` and
name → DuckDB oracle SQL over the same parquet tables.

Every query reads the whole driver tables (through the adapters in
``vigil.sources.tables``). Computed doubles are rounded to 6 digits on both
sides so that summation order cannot change the compared values; timestamps
are compared as ISO text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import scalars
from vigil.functions.scalars import round_to
from vigil.operators import drift
from vigil.plans import sql_views as V
from vigil.session import cut_lineage
from vigil.sources import tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

# The event table covers 2024-01-01 … 2024-01-30; monitoring runs "now" at its end.
NOW = _dt.datetime(2024, 1, 31, 0, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c, digits: int = 6):
    """``round(x·10^d)/10^d`` — the same float operations as the oracle's
    ``round(x, d)``, so ties round alike on both sides."""
    return round_to(c, digits)


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (see module doc)."""
    return df.select(*[rnd(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def ts_text(col: str, alias: str | None = None):
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or col)


SQL_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


# ── D1 mean-shift drift ──────────────────────────────────────────────────────

def _d1_sql(threshold: float) -> str:
    w = f"ts >= {NOW_SQL} - INTERVAL 24 HOUR"
    b = f"ts < {NOW_SQL} - INTERVAL 24 HOUR"

    def side(cond, p):
        return f"""
      count(fraud_score) FILTER (WHERE {cond}) AS {p}_n,
      avg(fraud_score) FILTER (WHERE {cond}) AS {p}_mean,
      stddev_samp(fraud_score) FILTER (WHERE {cond}) AS {p}_std,
      min(fraud_score) FILTER (WHERE {cond}) AS {p}_min,
      max(fraud_score) FILTER (WHERE {cond}) AS {p}_max,
      avg(CAST(is_fraud AS DOUBLE)) FILTER (WHERE {cond}) AS {p}_flag_rate"""
    stats = ", ".join(f"round({p}_{k}, 6) AS {p}_{k}" for p in ("window", "baseline")
                      for k in ("mean", "std", "min", "max", "flag_rate"))
    return V.with_(V.PREDICTIONS) + f""",
s AS (
  SELECT {side(w, 'window')}, {side(b, 'baseline')}
  FROM predictions
  WHERE ts >= {NOW_SQL} - INTERVAL 8 DAY AND ts <= {NOW_SQL}
    AND (fraud_score IS NULL OR fraud_score >= 0)),
d AS (
  SELECT *, CASE WHEN window_n >= 50 AND baseline_n >= 50
                 THEN abs(window_mean - baseline_mean) END AS drift
  FROM s)
SELECT window_n, baseline_n, {stats},
  round(drift, 6) AS drift_score,
  coalesce(drift > {threshold}, false) AS drift_detected,
  CAST({threshold} AS DOUBLE) AS threshold,
  CAST(24 AS DOUBLE) AS window_hours,
  CAST(7 AS DOUBLE) AS baseline_days
FROM d
"""


def _d1(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    log = tables.predictions(spark, sf_dir)
    return r6(drift.mean_shift_drift(log, NOW, threshold=threshold))


@register("d1_mean_shift_drift", _d1_sql(0.05))
def d1_mean_shift_drift(spark, sf_dir):
    return _d1(spark, sf_dir, 0.05)


@register("d1_mean_shift_drift_sensitive", _d1_sql(0.01))
def d1_mean_shift_drift_sensitive(spark, sf_dir):
    return _d1(spark, sf_dir, 0.01)


# ── monitoring (A9–A13, A20, T1–T3, P9, F12) ─────────────────────────────────

from vigil.operators import monitor  # noqa: E402

PRED_COLS_SQL = ("id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, symbol, price, quantity, "
                 "trade_time, is_buyer_maker, fraud_score, is_fraud, threshold")


def _pred_text(df: DataFrame) -> DataFrame:
    return df.select("id", ts_text("ts"), "symbol", "price", "quantity", "trade_time",
                     "is_buyer_maker", "fraud_score", "is_fraud", "threshold")


@register("a9_summary_stats", V.with_(V.DASHBOARD) + """
SELECT count(*) AS total,
       CAST(sum(is_fraud) AS BIGINT) AS flagged,
       round(avg(fraud_score), 6) AS avg_score,
       round(max(fraud_score), 6) AS max_score,
       round(avg(price), 6) AS avg_price,
       count(*) - coalesce(CAST(sum(is_fraud) AS BIGINT), 0) AS legit,
       round(CASE WHEN count(*) = 0 THEN 0.0
                  ELSE CAST(coalesce(sum(is_fraud), 0) AS DOUBLE) / count(*) * 100 END, 6) AS flag_rate_pct
FROM dash""")
def a9_summary_stats(spark, sf_dir):
    return r6(monitor.summary_stats(tables.dashboard_predictions(spark, sf_dir)))


@register("a10_volume_over_time", V.with_(V.DASHBOARD) + """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:')
         || lpad(CAST(CAST(floor(second(ts) / 10) * 10 AS INTEGER) AS VARCHAR), 2, '0') AS bucket,
       count(*) AS total,
       CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
       round(avg(fraud_score), 6) AS avg_score
FROM dash GROUP BY 1 ORDER BY bucket DESC LIMIT 60""")
def a10_volume_over_time(spark, sf_dir):
    return r6(monitor.volume_over_time(tables.dashboard_predictions(spark, sf_dir)))


@register("a11_volume_5s", V.with_(V.DASHBOARD) + """
SELECT strftime(time_bucket(INTERVAL 5 SECOND, ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket_start,
       count(fraud_score) AS total,
       CAST(sum(is_fraud) AS BIGINT) AS fraud,
       round(avg(fraud_score), 6) AS avg_score
FROM dash GROUP BY 1""")
def a11_volume_5s(spark, sf_dir):
    v = monitor.volume_by_window(tables.dashboard_predictions(spark, sf_dir))
    return r6(v.select(ts_text("bucket_start"), "total", "fraud", "avg_score"))


@register("a12_score_histogram", V.with_(V.DASHBOARD) + """,
c AS (SELECT is_fraud, CAST(least(floor(fraud_score * 40), 39) AS INTEGER) AS bin, count(*) AS n
      FROM dash WHERE fraud_score BETWEEN 0 AND 1 GROUP BY ALL),
g AS (SELECT CAST(l.range AS INTEGER) AS is_fraud, CAST(b.range AS INTEGER) AS bin
      FROM range(0, 2) l, range(0, 40) b)
SELECT g.is_fraud, g.bin, round(CAST(g.bin AS DOUBLE) / 40, 6) AS bin_start, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.is_fraud = c.is_fraud AND g.bin = c.bin""")
def a12_score_histogram(spark, sf_dir):
    return r6(monitor.score_histogram(tables.dashboard_predictions(spark, sf_dir)))


@register("a13_score_heatmap", V.with_(V.DASHBOARD) + """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS minute,
       CAST(floor(second(ts) / 10) * 10 AS INTEGER) AS slot,
       round(avg(fraud_score), 6) AS mean_score,
       count(*) AS n
FROM dash GROUP BY 1, 2""")
def a13_score_heatmap(spark, sf_dir):
    h = monitor.score_heatmap(tables.dashboard_predictions(spark, sf_dir))
    return r6(h.select(ts_text("minute"), "slot", "mean_score", "n"))


@register("t1_recent_predictions", V.with_(V.DASHBOARD) + f"""
SELECT {PRED_COLS_SQL} FROM dash ORDER BY dash.ts DESC, id DESC LIMIT 500""")
def t1_recent_predictions(spark, sf_dir):
    return _pred_text(monitor.recent(tables.dashboard_predictions(spark, sf_dir)))


@register("t2_fraud_alerts", V.with_(V.DASHBOARD) + f"""
SELECT {PRED_COLS_SQL} FROM dash WHERE is_fraud = 1 ORDER BY dash.ts DESC, id DESC LIMIT 50""")
def t2_fraud_alerts(spark, sf_dir):
    return _pred_text(monitor.fraud_alerts(tables.dashboard_predictions(spark, sf_dir)))


@register("a20_reader_status", V.with_(V.PREDICTIONS) + """
SELECT count(*) FILTER (WHERE fraud_score >= 0) AS total,
       count(*) FILTER (WHERE fraud_score < 0) AS errors,
       strftime(max(ts) FILTER (WHERE fraud_score >= 0), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
FROM predictions""")
def a20_reader_status(spark, sf_dir):
    s = monitor.reader_status(tables.predictions(spark, sf_dir))
    return s.select("total", "errors", ts_text("last_ts"))


@register("p9_score_band", V.with_(V.DASHBOARD) + """
SELECT id, fraud_score,
       CASE WHEN fraud_score >= 0.8 THEN 'high' WHEN fraud_score >= 0.5 THEN 'moderate'
            ELSE 'legit' END AS band
FROM dash""")
def p9_score_band(spark, sf_dir):
    return monitor.with_score_band(tables.dashboard_predictions(spark, sf_dir)) \
        .select("id", "fraud_score", "band")


@register("f12_parse_log_time", V.with_(V.PREDICTIONS) + """
SELECT id, CAST(hour(ts) AS INTEGER) AS hour,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS minute,
       CAST(floor(second(ts) / 10) * 10 AS INTEGER) AS slot
FROM predictions""")
def f12_parse_log_time(spark, sf_dir):
    p = tables.predictions(spark, sf_dir)
    text = p.select("id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    parts = monitor.log_time_parts(text)
    return parts.select("id", "hour", ts_text("minute"), "slot")


# ── joins (J1, J6) ───────────────────────────────────────────────────────────

from vigil.operators import checks, joins, profile  # noqa: E402


@register("j1_merge_identity", V.with_(V.IDENTITY) + "SELECT * FROM merged")
def j1_merge_identity(spark, sf_dir):
    return joins.merge_identity(tables.document_rows(spark, sf_dir),
                                tables.identity(spark, sf_dir), key="doc_id")


@register("j6_missing_keys", """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def j6_missing_keys(spark, sf_dir):
    return joins.missing_keys(tables.document_rows(spark, sf_dir),
                              tables.identity(spark, sf_dir), "doc_id")


@register("j6_matched_keys", """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars FROM documents d
WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def j6_matched_keys(spark, sf_dir):
    return joins.matched_keys(tables.document_rows(spark, sf_dir),
                              tables.identity(spark, sf_dir), "doc_id")


# ── profiling (A1, A3, A4, A14–A19, T5, T6) ──────────────────────────────────

_MERGED_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _null_rates_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6)"
             f" AS null_rate FROM merged" for c in _MERGED_COLS]
    return V.with_(V.IDENTITY) + "\nUNION ALL\n".join(parts)


def _merged(spark, sf_dir):
    return joins.merge_identity(tables.document_rows(spark, sf_dir),
                                tables.identity(spark, sf_dir), key="doc_id")


@register("a1_null_rates", _null_rates_sql())
def a1_null_rates(spark, sf_dir):
    return r6(profile.null_rates(_merged(spark, sf_dir))
              .withColumnRenamed("column", "column_name"))


@register("t5_top_null_columns",
          f"SELECT * FROM ({_null_rates_sql()}) WHERE null_rate > 0 "
          "ORDER BY null_rate DESC, column_name LIMIT 20")
def t5_top_null_columns(spark, sf_dir):
    rates = profile.null_rates(_merged(spark, sf_dir))
    return r6(profile.top_null_columns(rates, 20).withColumnRenamed("column", "column_name"))


@register("a3_class_balance", V.with_(V.TRANSACTIONS) + """,
c AS (SELECT isFraud AS label, count(*) AS n FROM transactions GROUP BY 1)
SELECT label, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c), 6) AS rate,
       CAST(floor((SELECT sum(n) FILTER (WHERE label = 0) FROM c)
                  / (SELECT sum(n) FILTER (WHERE label = 1) FROM c)) AS BIGINT) AS neg_per_pos
FROM c""")
def a3_class_balance(spark, sf_dir):
    return r6(profile.class_balance(tables.transactions(spark, sf_dir), "isFraud"))


@register("a4_class_weight", V.with_(V.TRANSACTIONS) + """
SELECT round(CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE isFraud = 1), 0), 6) AS class_weight
FROM transactions""")
def a4_class_weight(spark, sf_dir):
    return r6(profile.class_weight(tables.transactions(spark, sf_dir), "isFraud"))


@register("a14_label_rate_by_category", V.with_(V.TRANSACTIONS) + """
SELECT card4 AS value, round(avg(CAST(isFraud AS DOUBLE)), 6) AS label_rate, count(*) AS n
FROM transactions WHERE card4 IS NOT NULL GROUP BY card4""")
def a14_label_rate_by_category(spark, sf_dir):
    return r6(profile.label_rate_by_category(tables.transactions(spark, sf_dir), "card4", "isFraud"))


_Q10 = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"


@register("a15_label_rate_by_quantile", V.with_(V.TRANSACTIONS) + f""",
v AS (SELECT TransactionAmt AS x, isFraud FROM transactions
      WHERE TransactionAmt IS NOT NULL AND NOT isnan(TransactionAmt)),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, {_Q10}))) AS edges FROM v),
b AS (SELECT greatest(len(list_filter(e.edges, lambda q: q < v.x)), 1) AS bucket, v.isFraud, e.edges
      FROM v, e)
SELECT bucket, round(edges[bucket], 6) AS lower, round(edges[bucket + 1], 6) AS upper,
       round(avg(CAST(isFraud AS DOUBLE)), 6) AS label_rate, count(*) AS n
FROM b GROUP BY bucket, edges""")
def a15_label_rate_by_quantile(spark, sf_dir):
    return r6(profile.label_rate_by_quantile(tables.transactions(spark, sf_dir),
                                             "TransactionAmt", "isFraud", 10)
              .withColumn("bucket", F.col("bucket").cast("bigint")))


@register("a16_describe_amount", V.with_(V.TRANSACTIONS) + """
SELECT round(min(TransactionAmt), 6) AS min, round(quantile_cont(TransactionAmt, 0.5), 6) AS median,
       round(avg(TransactionAmt), 6) AS mean, round(max(TransactionAmt), 6) AS max
FROM transactions""")
def a16_describe_amount(spark, sf_dir):
    return r6(profile.describe(tables.transactions(spark, sf_dir), "TransactionAmt"))


def _hist_sql(expr: str, bins: int = 100) -> str:
    return V.with_(V.TRANSACTIONS) + f""",
v AS (SELECT {expr} AS x FROM transactions WHERE TransactionAmt IS NOT NULL),
r AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS step FROM v),
g AS (SELECT x, lo, hi, step,
             least(greatest(CAST(coalesce(floor((x - lo) / nullif(step, 0)), {bins - 1}) AS BIGINT), 0),
                   {bins - 1}) AS i0 FROM v, r),
b AS (SELECT CASE WHEN step = 0 THEN {bins - 1}
                  WHEN x < i0 * step + lo THEN i0 - 1
                  WHEN i0 < {bins - 1} AND x >= (CASE WHEN i0 + 1 >= {bins} THEN hi
                                                     ELSE (i0 + 1) * step + lo END) THEN i0 + 1
                  ELSE i0 END AS bin FROM g),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(k.range AS INTEGER) AS bin,
       round(k.range * r.step + r.lo, 6) AS lower,
       round(CASE WHEN k.range + 1 >= {bins} THEN r.hi ELSE (k.range + 1) * r.step + r.lo END, 6) AS upper,
       coalesce(c.n, 0) AS n
FROM range(0, {bins}) k CROSS JOIN r LEFT JOIN c ON c.bin = k.range"""


@register("a17_histogram_amount", _hist_sql("TransactionAmt"))
def a17_histogram_amount(spark, sf_dir):
    return r6(profile.histogram(tables.transactions(spark, sf_dir), "TransactionAmt", 100))


@register("a17_histogram_log_amount", _hist_sql("ln(1 + TransactionAmt)"))
def a17_histogram_log_amount(spark, sf_dir):
    return r6(profile.histogram(tables.transactions(spark, sf_dir), "TransactionAmt", 100, log=True))


_TX_NUMERIC = ["TransactionID", "TransactionDT", "TransactionAmt", "card1", "acct_balance"]


def _corr_sql() -> str:
    parts = [f"""SELECT '{c}' AS column_name,
  round(CASE WHEN stddev_pop(x) * stddev_pop(y) = 0 THEN NULL
             ELSE covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END, 6) AS corr
FROM (SELECT CAST({c} AS DOUBLE) AS x, CAST(isFraud AS DOUBLE) AS y FROM transactions
      WHERE {c} IS NOT NULL)""" for c in _TX_NUMERIC]
    return V.with_(V.TRANSACTIONS) + "\nUNION ALL\n".join(parts)


@register("a18_label_correlation", _corr_sql())
def a18_label_correlation(spark, sf_dir):
    return r6(profile.label_correlation(tables.transactions(spark, sf_dir), "isFraud")
              .withColumnRenamed("column", "column_name"))


@register("t6_top_correlated",
          f"SELECT * FROM ({_corr_sql()}) WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, column_name LIMIT 20")
def t6_top_correlated(spark, sf_dir):
    c = profile.label_correlation(tables.transactions(spark, sf_dir), "isFraud")
    return r6(profile.top_correlated(c, 20).withColumnRenamed("column", "column_name"))


@register("a19_distinct_label_check", V.with_(V.TRANSACTIONS) + """
SELECT count(DISTINCT isFraud) AS n_distinct, count(DISTINCT isFraud) = 2 AS passed FROM transactions""")
def a19_distinct_label_check(spark, sf_dir):
    return profile.distinct_label_check(tables.transactions(spark, sf_dir), "isFraud")


@register("e11_validate_transactions", V.with_(V.TRANSACTIONS) + """,
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT isFraud) AS DOUBLE) AS k,
             avg(CAST(isFraud AS DOUBLE)) AS rate, min(TransactionAmt) AS amt FROM transactions)
SELECT 'required_columns' AS "check", true AS passed, 0.0::DOUBLE AS observed, 0.0::DOUBLE AS "limit" FROM s
UNION ALL SELECT 'binary_label', k = 2, k, 2.0 FROM s
UNION ALL SELECT 'min_rows', n > 100000, n, 100000.0 FROM s
UNION ALL SELECT 'min_rows_documented', n >= 1000, n, 1000.0 FROM s
UNION ALL SELECT 'label_rate_low', coalesce(rate >= 0.001, false), round(rate, 6), 0.001 FROM s
UNION ALL SELECT 'label_rate_high', coalesce(rate <= 0.5, false), round(rate, 6), 0.5 FROM s
UNION ALL SELECT 'amount_non_negative', coalesce(amt >= 0, true), round(amt, 6), 0.0 FROM s""")
def e11_validate_transactions(spark, sf_dir):
    return r6(checks.validate_transactions(tables.transactions(spark, sf_dir)))


# ── drift family (D2–D8, A5–A8, W1, T3) ──────────────────────────────────────

W_START = NOW - _dt.timedelta(hours=24)
B_START = W_START - _dt.timedelta(days=7)
W_SQL = f"ts >= {NOW_SQL} - INTERVAL 24 HOUR AND ts <= {NOW_SQL}"
B_SQL = f"ts >= {NOW_SQL} - INTERVAL 8 DAY AND ts < {NOW_SQL} - INTERVAL 24 HOUR"
MONITORED = ["TransactionAmt", "hour_of_day", "day_of_week"]


def _period(df: DataFrame, lo, hi, hi_inclusive: bool) -> DataFrame:
    t = df.schema["ts"].dataType
    lo_l = F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast(t)
    hi_l = F.lit(hi.strftime("%Y-%m-%d %H:%M:%S")).cast(t)
    return df.where((F.col("ts") >= lo_l) & ((F.col("ts") <= hi_l) if hi_inclusive else (F.col("ts") < hi_l)))


def _windows(spark, sf_dir):
    """(recent 24 h, baseline 7 d before it) of successful predictions, with
    the monitored features in unscaled form (Q8/Q9)."""
    p = tables.predictions(spark, sf_dir).where(F.col("fraud_score") >= 0)
    feats = p.select("*", (F.col("price") * F.col("quantity")).alias("TransactionAmt"),
                     F.hour("ts").cast("double").alias("hour_of_day"),
                     F.weekday("ts").cast("double").alias("day_of_week"))
    return _period(feats, W_START, NOW, True), _period(feats, B_START, W_START, False)


FEATS_SQL = V.with_(V.PREDICTIONS) + f""",
feats AS (SELECT *, price * quantity AS TransactionAmt, CAST(hour(ts) AS DOUBLE) AS hour_of_day,
                 CAST(isodow(ts) - 1 AS DOUBLE) AS day_of_week
          FROM predictions WHERE fraud_score >= 0),
recent AS (SELECT * FROM feats WHERE {W_SQL}),
base AS (SELECT * FROM feats WHERE {B_SQL})"""


def _moments_sql(rel: str, prefix: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, count({f}) AS {prefix}_n, avg({f}) AS {prefix}_mean, "
        f"stddev_samp({f}) AS {prefix}_std FROM {rel}" for f in MONITORED)


@register("a6_recent_stats", V.with_(V.PREDICTIONS) + f"""
SELECT count(*) AS n_predictions, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate,
       round(avg(fraud_score), 6) AS avg_score, round(avg(price * quantity), 6) AS transaction_amt_mean,
       round(avg(CAST(hour(ts) AS DOUBLE)), 6) AS hour_of_day_mean
FROM predictions WHERE {W_SQL}""")
def a6_recent_stats(spark, sf_dir):
    p = _period(tables.predictions(spark, sf_dir), W_START, NOW, True)
    return r6(drift.recent_stats(p))


@register("a7_baseline_stats", FEATS_SQL + f"""
SELECT feature, base_n AS n, round(base_mean, 6) AS mean, round(base_std, 6) AS std
FROM ({_moments_sql('base', 'base')})""")
def a7_baseline_stats(spark, sf_dir):
    _, base = _windows(spark, sf_dir)
    return r6(drift.feature_moments(base, MONITORED))


@register("a8_flag_rate", V.with_(V.PREDICTIONS) + """
SELECT is_buyer_maker, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS flag_rate
FROM predictions GROUP BY is_buyer_maker""")
def a8_flag_rate(spark, sf_dir):
    return r6(drift.flag_rate(tables.predictions(spark, sf_dir), by=["is_buyer_maker"]))


@register("j3_compare_features", FEATS_SQL + f""",
r AS ({_moments_sql('recent', 'recent')}),
b AS ({_moments_sql('base', 'base')})
SELECT r.feature, round(abs(recent_mean - base_mean) / base_std, 4) AS z
FROM r JOIN b ON r.feature = b.feature
WHERE recent_mean IS NOT NULL AND base_mean IS NOT NULL AND base_std IS NOT NULL AND base_std <> 0""")
def j3_compare_features(spark, sf_dir):
    recent_df, base = _windows(spark, sf_dir)
    out = drift.zscore_drift(recent_df, base, MONITORED, baseline_rate="is_fraud")
    return out.select(F.explode("feature_z").alias("feature", "z")).select("feature", rnd(F.col("z"), 4).alias("z"))


@register("d2_zscore_drift", FEATS_SQL + f""",
r AS ({_moments_sql('recent', 'recent')}),
b AS ({_moments_sql('base', 'base')}),
z AS (SELECT r.feature, round(abs(recent_mean - base_mean) / base_std, 4) AS z
      FROM r JOIN b ON r.feature = b.feature
      WHERE recent_mean IS NOT NULL AND base_mean IS NOT NULL AND base_std <> 0),
rate AS (SELECT (SELECT count(*) FROM recent) AS n_recent,
                abs(coalesce((SELECT avg(CAST(is_fraud AS DOUBLE)) FROM recent), 0)
                    - coalesce((SELECT avg(CAST(is_fraud AS DOUBLE)) FROM base), 0.035)) AS change)
SELECT n_recent, round(change, 6) AS fraud_rate_change,
       CAST((change > 0.05)::INTEGER + (SELECT count(*) FROM z WHERE z > 3.0) AS INTEGER) AS n_reasons,
       (change > 0.05) OR (SELECT count(*) FROM z WHERE z > 3.0) > 0 AS drift_detected
FROM rate""")
def d2_zscore_drift(spark, sf_dir):
    recent_df, base = _windows(spark, sf_dir)
    out = drift.zscore_drift(recent_df, base, MONITORED, baseline_rate="is_fraud")
    return r6(out.select("n_recent", "fraud_rate_change", F.size("reason").alias("n_reasons"),
                         "drift_detected"))


def _bin_sql(x: str, n: int) -> str:
    """numpy edge semantics over columns lo, hi, step (see functions/bins.py)."""
    i0 = (f"least(greatest(CAST(coalesce(floor(({x} - lo) / nullif(step, 0)), {n - 1}) AS BIGINT), 0), "
          f"{n - 1})")
    edge = lambda i: f"(CASE WHEN {i} >= {n} THEN hi ELSE ({i}) * step + lo END)"
    return (f"CASE WHEN step = 0 THEN {n - 1} WHEN {x} < {edge(i0)} THEN {i0} - 1 "
            f"WHEN {i0} < {n - 1} AND {x} >= {edge(f'{i0} + 1')} THEN {i0} + 1 ELSE {i0} END")


def _psi_sql(value: str, by: bool, bins: int = 10) -> str:
    feat = "feature" if by else "'all'"
    if by:
        src = "\nUNION ALL\n".join(
            f"SELECT '{f}' AS feature, 'e' AS side, {f} AS v FROM base UNION ALL "
            f"SELECT '{f}', 'a', {f} FROM recent" for f in MONITORED)
    else:
        src = f"SELECT 'all' AS feature, 'e' AS side, {value} AS v FROM base UNION ALL " \
              f"SELECT 'all', 'a', {value} FROM recent"
    return FEATS_SQL + f""",
bothv AS (SELECT * FROM ({src}) WHERE v IS NOT NULL AND NOT isnan(v)),
r AS (SELECT feature, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS step
      FROM bothv GROUP BY feature),
g AS (SELECT b.feature, side, {_bin_sql('v', bins)} AS bin
      FROM bothv b JOIN r ON b.feature = r.feature),
c AS (SELECT feature, bin, count(*) FILTER (WHERE side = 'e') AS e_c,
             count(*) FILTER (WHERE side = 'a') AS a_c FROM g GROUP BY ALL),
t AS (SELECT feature, sum(e_c) AS e_n, sum(a_c) AS a_n FROM c GROUP BY feature),
f AS (SELECT t.feature, k.range AS bin, coalesce(c.e_c, 0) AS e_c, coalesce(c.a_c, 0) AS a_c, e_n, a_n
      FROM t CROSS JOIN range(0, {bins}) k LEFT JOIN c ON c.feature = t.feature AND c.bin = k.range),
p AS (SELECT feature, (e_c + 1e-6) / (e_n + 1e-6 * {bins}) AS e_p, (a_c + 1e-6) / (a_n + 1e-6 * {bins}) AS a_p,
             e_n, a_n FROM f),
s AS (SELECT feature, sum((a_p - e_p) * ln(a_p / e_p)) AS psi, CAST(any_value(e_n) AS BIGINT) AS expected_n,
             CAST(any_value(a_n) AS BIGINT) AS actual_n FROM p GROUP BY feature)
SELECT {'feature, ' if by else ''}round(psi, 6) AS psi, expected_n, actual_n,
       CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'minor' ELSE 'significant' END AS psi_band
FROM s"""


@register("d3_psi_score", _psi_sql("fraud_score", by=False))
def d3_psi_score(spark, sf_dir):
    recent_df, base = _windows(spark, sf_dir)
    return r6(drift.psi(base, recent_df, "fraud_score"))


@register("d3_psi_features", _psi_sql("", by=True))
def d3_psi_features(spark, sf_dir):
    recent_df, base = _windows(spark, sf_dir)
    long = lambda d: d.select(*[F.col(c).cast("double") for c in MONITORED]) \
        .unpivot([], MONITORED, "feature", "value")
    return r6(drift.psi(long(base), long(recent_df), "value", by=["feature"], few_groups=True))


def _d5_sql(by: str | None, n: int = 50, digits: int = 6) -> str:
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    return V.with_(V.PREDICTIONS) + f""",
ok AS (SELECT {key}id, ts, fraud_score - 0.5 AS x, fraud_score FROM predictions WHERE fraud_score >= 0),
sq AS (SELECT *, row_number() OVER ({part}ORDER BY ts, id) AS seq FROM ok),
w AS (SELECT {key}(seq - 1) // {n} AS window_no, count(*) AS cnt, sum(x) AS sx, sum(x * x) AS sxx,
             avg(fraud_score) AS w_mean, stddev_pop(fraud_score) AS w_std, max(ts) AS ts_end
      FROM sq GROUP BY ALL HAVING count(*) = {n}),
r AS (SELECT *, sum(cnt) OVER ({part}ORDER BY window_no) AS n_all,
             sum(sx) OVER ({part}ORDER BY window_no) AS s_all,
             sum(sxx) OVER ({part}ORDER BY window_no) AS ss_all FROM w),
z AS (SELECT *, sqrt(greatest(ss_all / n_all - (s_all / n_all) * (s_all / n_all), 0)) AS g_std FROM r)
SELECT {key}CAST(window_no AS BIGINT) AS window_no,
       strftime(ts_end, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       round(abs((w_mean - 0.5) - s_all / n_all) / CASE WHEN g_std = 0 THEN 1e-6 ELSE g_std END, {digits}) AS drift_score,
       round(w_mean, {digits}) AS mean_score, round(w_std, {digits}) AS std_score,
       CAST(cnt AS INTEGER) AS window_size
FROM z WHERE n_all >= 2"""


def _d5(spark, sf_dir, by=()):
    # Unrounded here; ``rnd`` applies the oracle's rounding once.
    d = drift.count_window_drift(tables.predictions(spark, sf_dir), by=by, digits=None)
    return d.select(*by, "window_no", ts_text("ts"), rnd(F.col("drift_score")).alias("drift_score"),
                    rnd(F.col("mean_score")).alias("mean_score"),
                    rnd(F.col("std_score")).alias("std_score"), "window_size")


@register("d5_count_window_drift", _d5_sql(None))
def d5_count_window_drift(spark, sf_dir):
    return _d5(spark, sf_dir)


@register("d5_count_window_drift_by_side", _d5_sql("is_buyer_maker"))
def d5_count_window_drift_by_side(spark, sf_dir):
    return _d5(spark, sf_dir, by=["is_buyer_maker"])


@register("t3_drift_history", f"SELECT * FROM ({_d5_sql(None)}) ORDER BY ts DESC, window_no DESC LIMIT 200")
def t3_drift_history(spark, sf_dir):
    d = drift.count_window_drift(tables.predictions(spark, sf_dir), digits=None)
    h = monitor.drift_history(d, 200)
    return h.select("window_no", ts_text("ts"), rnd(F.col("drift_score")).alias("drift_score"),
                    rnd(F.col("mean_score")).alias("mean_score"),
                    rnd(F.col("std_score")).alias("std_score"), "window_size")


@register("w1_sequence_number", V.with_(V.PREDICTIONS) + """
SELECT id, row_number() OVER (ORDER BY ts, id) AS seq FROM predictions""")
def w1_sequence_number(spark, sf_dir):
    from vigil.operators.sequence import sequence_number
    p = tables.predictions(spark, sf_dir).select("id", "ts")
    return sequence_number(p, ["ts", "id"]).select("id", "seq")


@register("d6_drift_decision", f"""
SELECT *, CASE WHEN drift_score IS NOT NULL AND drift_detected THEN 'drift_detected'
               ELSE 'no_drift' END AS decision
FROM ({_d1_sql(0.01)})""")
def d6_drift_decision(spark, sf_dir):
    return drift.drift_decision(_d1(spark, sf_dir, 0.01))


@register("d7_drift_alert", f"""
SELECT 'FRAUD_SCORE_DRIFT' AS alert_type,
       CASE WHEN drift_score > 2 * threshold THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       window_mean, baseline_mean, drift_score, threshold
FROM ({_d1_sql(0.01)}) WHERE drift_score IS NOT NULL AND drift_detected""")
def d7_drift_alert(spark, sf_dir):
    alert = drift.drift_alert(_d1(spark, sf_dir, 0.01),
                              keep=["window_mean", "baseline_mean", "drift_score", "threshold"])
    return alert.select("alert_type", "severity", "window_mean", "baseline_mean", "drift_score", "threshold")


@register("d8_retrain_request", f"""
SELECT 'drift_detection' AS triggered_by, drift_score, '{NOW.isoformat()}' AS triggered_at
FROM ({_d1_sql(0.01)}) WHERE drift_score IS NOT NULL AND drift_detected""")
def d8_retrain_request(spark, sf_dir):
    return drift.retrain_request(_d1(spark, sf_dir, 0.01), NOW.isoformat())


# ── features (F1–F7, A2, J4) ─────────────────────────────────────────────────

from vigil.operators import features as feat  # noqa: E402

_TX_FEATURES = ["TransactionAmt", "ProductCD", "card4", "card1", "acct_balance",
                "hour_of_day", "day_of_week"]
_TX_UNSCALED_SQL = V.with_(V.TRANSACTIONS) + """,
t AS (SELECT TransactionID,
             fmod(CAST(TransactionDT AS DOUBLE) / 3600, 24) AS hour_of_day,
             fmod(CAST(TransactionDT AS DOUBLE) / 86400, 7) AS day_of_week,
             ln(1 + TransactionAmt) AS TransactionAmt,
             coalesce(ProductCD, 'missing') AS pcd, coalesce(card4, 'missing') AS c4,
             card1, acct_balance, isFraud FROM transactions),
e1 AS (SELECT pcd, CAST(row_number() OVER (ORDER BY pcd) - 1 AS DOUBLE) AS code
       FROM (SELECT DISTINCT pcd FROM t)),
e2 AS (SELECT c4, CAST(row_number() OVER (ORDER BY c4) - 1 AS DOUBLE) AS code
       FROM (SELECT DISTINCT c4 FROM t)),
u AS (SELECT TransactionID, coalesce(TransactionAmt, -999.0) AS TransactionAmt,
             coalesce(e1.code, -999.0) AS ProductCD, coalesce(e2.code, -999.0) AS card4,
             coalesce(card1, -999.0) AS card1, coalesce(acct_balance, -999.0) AS acct_balance,
             hour_of_day, day_of_week, isFraud
      FROM t LEFT JOIN e1 ON t.pcd = e1.pcd LEFT JOIN e2 ON t.c4 = e2.c4)"""


def _scaled_sql(c: str) -> str:
    return (f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
            f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}")


@register("f1_time_features", V.with_(V.TRANSACTIONS) + """
SELECT TransactionID, round(fmod(CAST(TransactionDT AS DOUBLE) / 3600, 24), 6) AS hour_of_day,
       round(fmod(CAST(TransactionDT AS DOUBLE) / 86400, 7), 6) AS day_of_week FROM transactions""")
def f1_time_features(spark, sf_dir):
    t = feat.time_feature_frame(tables.transactions(spark, sf_dir))
    return r6(t.select("TransactionID", "hour_of_day", "day_of_week"))


@register("f2_log_transform", V.with_(V.TRANSACTIONS) + """
SELECT TransactionID, round(ln(1 + TransactionAmt), 6) AS TransactionAmt FROM transactions""")
def f2_log_transform(spark, sf_dir):
    t = tables.transactions(spark, sf_dir)
    return r6(t.select("TransactionID", F.log1p("TransactionAmt").alias("TransactionAmt")))


@register("f3_encode_categoricals", _TX_UNSCALED_SQL + """
SELECT 'ProductCD' AS "column", pcd AS value, CAST(code AS INTEGER) AS code FROM e1
UNION ALL SELECT 'card4', c4, CAST(code AS INTEGER) FROM e2""")
def f3_encode_categoricals(spark, sf_dir):
    return feat.fit_encoders(tables.transactions(spark, sf_dir), ["ProductCD", "card4"])


@register("f4_fill_nulls", V.with_(V.IDENTITY) + """
SELECT doc_id, lang, source, coalesce(CAST(n_chars AS DOUBLE), -999.0) AS n_chars,
       coalesce(CAST(quality AS DOUBLE), -999.0) AS quality,
       coalesce(CAST(toxic AS DOUBLE), -999.0) AS toxic FROM merged""")
def f4_fill_nulls(spark, sf_dir):
    m = _merged(spark, sf_dir)
    num = ["n_chars", "quality", "toxic"]
    return m.select("doc_id", "lang", "source", *[
        F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(-999.0)), F.lit(-999.0)).alias(c) for c in num])


@register("f5_standard_scale_fit", _TX_UNSCALED_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM u"
    for c in _TX_FEATURES))
def f5_standard_scale_fit(spark, sf_dir):
    m = feat.fit_features(tables.transactions(spark, sf_dir), label="isFraud")
    unscaled = m.transform(tables.transactions(spark, sf_dir), scale=False, with_label=False)
    return r6(feat.fit_scaler(unscaled, m.feature_cols))


@register("f6_class_weight_column", V.with_(V.TRANSACTIONS) + """
SELECT TransactionID, isFraud,
       round(CASE WHEN isFraud = 1 THEN (SELECT CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE)
                                               / count(*) FILTER (WHERE isFraud = 1) FROM transactions)
                  ELSE 1.0 END, 6) AS weight
FROM transactions""")
def f6_class_weight_column(spark, sf_dir):
    t = tables.transactions(spark, sf_dir)
    w = profile.class_weight(t, "isFraud").collect()[0]["class_weight"]
    return r6(t.select("TransactionID", "isFraud", feat.class_weight_column("isFraud", w)))


@register("f7_apply_features", _TX_UNSCALED_SQL + "\nSELECT TransactionID, "
          + ", ".join(_scaled_sql(c) for c in _TX_FEATURES) + ", isFraud FROM u")
def f7_apply_features(spark, sf_dir):
    t = tables.transactions(spark, sf_dir)
    m = feat.fit_features(t, label="isFraud")
    return r6(m.transform(t, keep=["TransactionID"]))


@register("k5_feature_metadata_roundtrip", ORACLE["f7_apply_features"])
def k5_feature_metadata_roundtrip(spark, sf_dir):
    """K5 + S9: the fitted pipeline saved as tables (encoders, feature stats,
    config row), loaded back and applied — must equal F7."""
    t = tables.transactions(spark, sf_dir)
    path = streams.scratch(spark, "k5")
    feat.fit_features(t, label="isFraud").save(spark, path)
    return r6(feat.FeatureModel.load(spark, path).transform(t, keep=["TransactionID"]))


@register("a2_drop_high_null_columns", V.with_(V.IDENTITY) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, "
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.9 AS dropped FROM merged" for c in _MERGED_COLS))
def a2_drop_high_null_columns(spark, sf_dir):
    rates = profile.null_rates(_merged(spark, sf_dir))
    return r6(rates.select(F.col("column").alias("column_name"), "null_rate",
                           (F.col("null_rate") > feat.NULL_THRESHOLD).alias("dropped")))


# ── evaluation (E1–E5, T8, W3, W4) ───────────────────────────────────────────

from vigil.operators import evaluate as ev  # noqa: E402

_TH_SQL = "[0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]"


def _auc_sql(by: str | None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    return V.with_(V.LABELLED) + f""",
g AS (SELECT {key}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
      FROM labelled_scores GROUP BY ALL),
c AS (SELECT *, sum(neg) OVER ({part}ORDER BY score) AS neg_le FROM g)
SELECT {key}round(sum(pos * (neg_le - neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM c {'GROUP BY ' + by if by else ''}"""


@register("e2_roc_auc", _auc_sql(None))
def e2_roc_auc(spark, sf_dir):
    return r6(ev.roc_auc(tables.labelled_scores(spark, sf_dir)))


@register("e2_roc_auc_by_segment", _auc_sql("segment"))
def e2_roc_auc_by_segment(spark, sf_dir):
    return r6(ev.roc_auc(tables.labelled_scores(spark, sf_dir), by=["segment"]))


# T4: a metrics history — exact AUC of the labelled scores per segment and
# ship month, one metrics row per (segment, deployed_at) — and the current
# model per segment, the row with the latest deployed_at.
def _auc_history(spark, sf_dir):
    """Exact AUC per segment and month: a history of deployed metrics."""
    li = tables.read_table(spark, sf_dir, "lineitem")
    scored = li.select(F.col("l_linestatus").alias("segment"),
                       F.date_trunc("month", "l_shipdate").alias("deployed_at"),
                       (F.col("l_returnflag") == "R").cast("int").alias("label"),
                       F.least(F.col("l_extendedprice") / 100000.0, F.lit(1.0)).alias("score"))
    return ev.roc_auc(scored, by=["segment", "deployed_at"])


_AUC_HISTORY_SQL = """WITH ls AS (SELECT l_linestatus AS segment, date_trunc('month', l_shipdate) AS deployed_at,
                   CAST(l_returnflag = 'R' AS INTEGER) AS label,
                   least(l_extendedprice / 100000.0, 1.0) AS score FROM lineitem),
g AS (SELECT segment, deployed_at, score, count(*) FILTER (WHERE label = 1) AS pos,
             count(*) FILTER (WHERE label <> 1) AS neg FROM ls GROUP BY ALL),
c AS (SELECT *, sum(neg) OVER (PARTITION BY segment, deployed_at ORDER BY score) AS neg_le FROM g),
m AS (SELECT segment, deployed_at,
             sum(pos * (neg_le - neg / 2.0))
               / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc,
             CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
      FROM c GROUP BY segment, deployed_at)
"""


@register("t4_current_model", _AUC_HISTORY_SQL + f"""
SELECT segment, {SQL_TS.format(c='deployed_at')} AS deployed_at, round(auc, 6) AS auc, n_pos, n_neg
FROM m QUALIFY row_number() OVER (PARTITION BY segment ORDER BY deployed_at DESC) = 1""")
def t4_current_model(spark, sf_dir):
    metrics = _auc_history(spark, sf_dir)
    cur = tr.current_model(metrics, key=["segment"], ts_col="deployed_at")
    return r6(cur.select("segment", ts_text("deployed_at"), "auc", "n_pos", "n_neg"))


@register("e9_gate_outcomes", _AUC_HISTORY_SQL + f"""
SELECT c.segment, {SQL_TS.format(c='c.deployed_at')} AS deployed_at, round(c.auc, 6) AS auc,
       round(p.auc, 6) AS current_auc, round(c.auc - p.auc, 6) AS improvement,
       CASE WHEN c.auc IS NULL THEN false WHEN p.auc IS NULL THEN true ELSE c.auc - p.auc >= 0.005 END AS deploy,
       CASE WHEN c.auc IS NULL THEN 'skip_no_auc' WHEN p.auc IS NULL THEN 'first_deployment'
            WHEN c.auc - p.auc >= 0.005 THEN 'deploy' ELSE 'keep_current' END AS reason
FROM m c LEFT JOIN m p ON c.segment = p.segment AND p.deployed_at + INTERVAL 1 MONTH = c.deployed_at""")
def e9_gate_outcomes(spark, sf_dir):
    """E9 against stored metrics: every month's model of a segment is the
    candidate to the month before it; all four outcomes occur."""
    history = cut_lineage(_auc_history(spark, sf_dir).select("segment", "deployed_at", "auc"))
    stored = history.select("segment", F.add_months("deployed_at", 1).cast("timestamp").alias("deployed_at"), "auc")
    gate = joins.compare_models(history.withColumn("deployed_at", F.col("deployed_at").cast("timestamp")), stored,
                                key=["segment", "deployed_at"])
    return r6(gate.select("segment", ts_text("deployed_at"), "auc", "current_auc", "improvement", "deploy", "reason"))


@register("f11_round6", """
SELECT event_id, round(value / 7.0, 6) AS rounded FROM events""")
def f11_round6(spark, sf_dir):
    ev_ = tables.read_table(spark, sf_dir, "events")
    return ev_.select("event_id", scalars.round6(F.col("value") / 7.0).alias("rounded"))


@register("p3_order_features", V.with_(V.TRANSACTIONS) + """
SELECT TransactionID, coalesce(card1, -999.0) AS v0, CAST(-999 AS DOUBLE) AS v1, coalesce(TransactionAmt, -999.0) AS v2
FROM transactions""")
def p3_order_features(spark, sf_dir):
    t = trd.order_features(tables.transactions(spark, sf_dir), ["card1", "not_there", "TransactionAmt"])
    return t.select("TransactionID", *[F.get("feature_vector", F.lit(k)).alias(f"v{k}") for k in range(3)])


@register("e12_retrain_history", V.with_(V.PREDICTIONS) + """,
r AS (SELECT strftime(ts, '%Y-%m-%d') AS completed_at, count(*) AS n_rows, round(avg(fraud_score), 6) AS score
      FROM predictions GROUP BY 1)
SELECT completed_at, CASE WHEN n_rows % 2 = 0 THEN 'drift_detection' ELSE 'manual' END AS triggered_by, n_rows, score
FROM r QUALIFY row_number() OVER (ORDER BY completed_at DESC) <= 20""")
def e12_retrain_history(spark, sf_dir):
    """S7 + E12: one report per day appended as JSON documents, read back with
    a schema; the latest 20, a missing trigger reads as manual."""
    p = tables.predictions(spark, sf_dir)
    daily = p.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("completed_at")).agg(
        F.count(F.lit(1)).alias("n_rows"), rnd(F.avg("fraud_score")).alias("score"))
    path = streams.scratch(spark, "retrain")
    daily.withColumn("triggered_by", F.when(F.col("n_rows") % 2 == 0, "drift_detection")).write.json(path)
    docs = readers.read_metric_docs(spark, path, "completed_at string, triggered_by string, n_rows bigint, score double")
    return tr.retrain_history(docs, 20).select("completed_at", "triggered_by", "n_rows", "score")


_E3_SQL = V.with_(V.LABELLED) + f""",
th AS (SELECT unnest({_TH_SQL}) AS threshold),
c AS (SELECT threshold,
             count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= threshold AND label <> 1) AS fp,
             count(*) FILTER (WHERE NOT (score >= threshold) AND label = 1) AS fn,
             count(*) FILTER (WHERE NOT (score >= threshold) AND label <> 1) AS tn
      FROM th, labelled_scores GROUP BY threshold),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r,
                CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS f FROM c),
e3 AS (SELECT threshold, round(p, 4) AS precision, round(r, 4) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1, round(f, 4) AS fpr,
       tp, fp, fn, tn, tp + fp AS flagged, fn AS missed FROM m)"""


@register("e3_threshold_metrics", _E3_SQL + "\nSELECT * FROM e3")
def e3_threshold_metrics(spark, sf_dir):
    return _e3(spark, sf_dir)


def _e3(spark, sf_dir):
    """Unrounded metrics, then the oracle's 4-digit rounding applied once."""
    m = ev.threshold_metrics(tables.labelled_scores(spark, sf_dir), digits=None)
    return m.select(*[rnd(F.col(c), 4).alias(c) if c in ("precision", "recall", "f1", "fpr") else c
                      for c in m.columns])


@register("t8_recommend_threshold", _E3_SQL + """
SELECT threshold, precision, recall, recall >= 0.7 AS meets_min_recall FROM e3
ORDER BY (recall >= 0.7) DESC, CASE WHEN recall >= 0.7 THEN precision END DESC NULLS LAST,
         CASE WHEN recall < 0.7 THEN recall END DESC NULLS LAST, threshold LIMIT 1""")
def t8_recommend_threshold(spark, sf_dir):
    return ev.recommend_threshold(_e3(spark, sf_dir))


_CM_SQL = V.with_(V.LABELLED) + """,
c AS (SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
             count(*) FILTER (WHERE NOT (score >= 0.5) AND label = 1) AS fn,
             count(*) FILTER (WHERE NOT (score >= 0.5) AND label <> 1) AS tn FROM labelled_scores)"""


@register("e4_confusion_matrix", _CM_SQL + """
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")
def e4_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(tables.labelled_scores(spark, sf_dir), threshold=0.5)


@register("e5_classification_report", _CM_SQL + """,
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
                CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
                CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
                CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0 FROM c),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
                CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
                s0 + s1 AS n FROM m)
SELECT '0' AS class, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1,
       CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 4), round(r1, 4), round(f1, 4), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 4),
                 CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4),
                 CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END, 4),
                 round(CASE WHEN n > 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END, 4),
                 round(CASE WHEN n > 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0.0 END, 4),
                 CAST(n AS BIGINT) FROM f""")
def e5_classification_report(spark, sf_dir):
    r = ev.classification_report(tables.labelled_scores(spark, sf_dir), threshold=0.5, digits=None)
    return r.select(*[rnd(F.col(c), 4).alias(c) if c in ("precision", "recall", "f1") else c
                      for c in r.columns])


@register("e1_stratified_split", V.with_(V.LABELLED) + """,
n AS (SELECT label, count(*) AS n FROM labelled_scores GROUP BY label),
k AS (SELECT label, n, CASE WHEN n < 2 THEN 0 ELSE greatest(1, least(n - 1, CAST(floor(0.2 * n + 0.5) AS BIGINT))) END AS k FROM n)
SELECT label, k AS n_test, n - k AS n_train, true AS hash_order FROM k""")
def e1_stratified_split(spark, sf_dir):
    """Sizes per class, and whether every test row precedes every training row
    in the seeded hash order, which with the sizes fixes the test set."""
    keys = ["order_key", "line_number"]
    s = ev.stratified_split(tables.labelled_scores(spark, sf_dir), "label", keys).withColumn(
        "_at", F.struct(F.xxhash64(*keys, F.lit(ev.SEED)), *keys))
    return s.groupBy("label").agg(
        F.count_if("is_test").alias("n_test"), F.count_if(~F.col("is_test")).alias("n_train"),
        (F.max(F.when(F.col("is_test"), F.col("_at"))) < F.min(F.when(~F.col("is_test"), F.col("_at")))).alias("hash_order"))


# ── training and scoring (E6–E10, T7, T9, F8–F10, F13, J5) ───────────────────

from vigil.operators import train as tr  # noqa: E402
from vigil.operators import trades as trd  # noqa: E402
from vigil.operators import trees  # noqa: E402
from vigil.plans import training  # noqa: E402


@register("e6_train_classifier")
def e6_train_classifier(spark, sf_dir):
    """Reference parameters (depth 6, η 0.1, at most 200 rounds, subsample /
    colsample 0.8, class weight, seed 42, stop after 20 rounds without
    validation-AUC gain); one summary row."""
    run = training.training_run(spark, sf_dir)
    gbt = run.model.stages[-1]
    stop = training.stopping_summary(run)
    auc = ev.roc_auc(run.scored_test, "isFraud", "fraud_score")
    return auc.select(F.lit(gbt.getNumTrees).alias("n_trees"),
                      F.lit(len(run.features.feature_cols)).alias("n_features"), "auc", "n_pos", "n_neg",
                      F.lit(stop["best_iteration"]).cast("int").alias("best_iteration"),
                      F.lit(stop["best_val_auc"]).cast("double").alias("best_val_auc"),
                      F.lit(stop["stopped_at"]).cast("int").alias("patience_stop_round"))


@register("e7_score_batch")
def e7_score_batch(spark, sf_dir):
    run = training.training_run(spark, sf_dir)
    from vigil.functions.scalars import flag
    return run.scored_test.select("TransactionID", "isFraud", "fraud_score",
                                  flag("fraud_score", 0.5).alias("is_fraud"))


@register("t7_top_importance")
def t7_top_importance(spark, sf_dir):
    run = training.training_run(spark, sf_dir)
    return tr.feature_importance(spark, run.model, run.features.feature_cols, 10)


@register("e10_evaluation_report")
def e10_evaluation_report(spark, sf_dir):
    return training.evaluation_report(spark, training.training_run(spark, sf_dir))


@register("e9_promotion_gate")
def e9_promotion_gate(spark, sf_dir):
    """Candidate = the fresh model's best validation AUC over rounds (what the
    reference reports); current = the last deployed model from the metrics
    table (none yet → first deployment)."""
    run = training.training_run(spark, sf_dir)
    best = training.stopping_summary(run)["best_val_auc"]
    cand = spark.createDataFrame([("fraud_gbt", best)], "model_name string, auc double")
    current = spark.createDataFrame([], "model_name string, auc double, deployed_at timestamp")
    return joins.compare_models(cand, tr.current_model(current, key=["model_name"]))


_TRADE_FEATURES = ["TransactionAmt", "ProductCD", "card4", "card1", "acct_balance",
                   "hour_of_day", "day_of_week"]


@register("f10_map_trade", V.with_(V.PREDICTIONS) + """
SELECT id AS trade_id, symbol,
       round(ln(1 + price * quantity), 6) AS TransactionAmt,
       CAST(-999 AS DOUBLE) AS ProductCD, CAST(-999 AS DOUBLE) AS card4,
       CAST(-999 AS DOUBLE) AS card1, CAST(-999 AS DOUBLE) AS acct_balance,
       CAST(hour(ts) AS DOUBLE) AS hour_of_day, CAST(isodow(ts) - 1 AS DOUBLE) AS day_of_week
FROM predictions""")
def f10_map_trade(spark, sf_dir):
    m = trd.map_trade(tables.trades(spark, sf_dir), _TRADE_FEATURES)
    return r6(m.select("trade_id", "symbol", *_TRADE_FEATURES))


@register("f13_parse_trade_json", V.with_(V.PREDICTIONS) + """
SELECT 'trade' AS event_type, id AS trade_id, symbol, price, quantity,
       trade_time AS trade_ms, trade_time AS event_ms, is_buyer_maker, 'binance' AS source
FROM predictions""")
def f13_parse_trade_json(spark, sf_dir):
    p = trd.parse_trades(tables.trade_json(spark, sf_dir).select("value"))
    return p.select("event_type", "trade_id", "symbol", F.col("price").cast("double").alias("price"),
                    F.col("quantity").cast("double").alias("quantity"), "trade_ms", "event_ms",
                    "is_buyer_maker", "source")


# A stated model: two small trees over raw transaction columns, as node rows
# (tree, weight, node, feature, split, left, right, leaf, gain, n).
_STATED_TREES = [
    (0, 1.0, 0, "TransactionAmt", 150000.0, 1, 2, None, 0.04, 1000.0), (0, 1.0, 1, None, None, None, None, -0.4, None, 600.0),
    (0, 1.0, 2, "acct_balance", 5000.0, 3, 4, None, 0.02, 400.0), (0, 1.0, 3, None, None, None, None, 0.1, None, 250.0),
    (0, 1.0, 4, None, None, None, None, 0.9, None, 150.0),
    (1, 0.5, 0, "card1", 12.0, 1, 2, None, 0.01, 1000.0), (1, 0.5, 1, "TransactionAmt", 60000.0, 3, 4, None, 0.03, 500.0),
    (1, 0.5, 2, None, None, None, None, -0.2, None, 500.0), (1, 0.5, 3, None, None, None, None, 0.3, None, 200.0),
    (1, 0.5, 4, None, None, None, None, -0.6, None, 300.0)]
_STATED_FEATURES = ["TransactionAmt", "card1", "acct_balance"]


def _sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)


_TREES_SQL = "trees(tree, weight, node, feature, split, l, r, leaf, gain, n) AS (VALUES " + ", ".join(
    "(" + ", ".join(map(_sql_value, row)) + ")" for row in _STATED_TREES) + ")"


@register("e8_tree_table_scores", "WITH RECURSIVE " + V.TRANSACTIONS.strip() + ", " + _TREES_SQL + """,
walk AS (
  SELECT t.TransactionID, t.TransactionAmt, t.card1, t.acct_balance, r.tree, 0 AS node
  FROM transactions t, (SELECT DISTINCT tree FROM trees) r
  UNION ALL
  SELECT w.TransactionID, w.TransactionAmt, w.card1, w.acct_balance, w.tree,
         CASE WHEN CASE n.feature WHEN 'TransactionAmt' THEN w.TransactionAmt WHEN 'card1' THEN w.card1
                   ELSE w.acct_balance END <= n.split THEN n.l ELSE n.r END
  FROM walk w JOIN trees n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL)
SELECT w.TransactionID, round(1 / (1 + exp(-2 * sum(n.weight * n.leaf))), 6) AS fraud_score,
       CAST(sum(n.weight * n.leaf) >= 0 AS INTEGER) AS is_fraud
FROM walk w JOIN trees n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NULL GROUP BY w.TransactionID""")
def e8_tree_table_scores(spark, sf_dir):
    """The stated trees, written as a model's node table, loaded and applied to
    all transactions."""
    path = streams.scratch(spark, "e8")
    trees.save_trees(spark.createDataFrame(_STATED_TREES, trees.TREE_SCHEMA), path)
    model = trees.TreeModel.of(trees.load_trees(spark, path), _STATED_FEATURES)
    scored = tr.score(model, tables.transactions(spark, sf_dir).select("TransactionID", *_STATED_FEATURES))
    return scored.select("TransactionID", rnd(F.col("fraud_score"), 6).alias("fraud_score"),
                         _flag("fraud_score", 0.5).cast("int").alias("is_fraud"))


# ── streaming (M1–M4): stream over a file source = batch result ─────────────

from vigil.plans import streams  # noqa: E402
from vigil.streaming import scoring  # noqa: E402


@register("m1_score_trades_stream")
def m1_score_trades_stream(spark, sf_dir):
    run = training.training_run(spark, sf_dir)
    log = streams.scored_log_stream(spark, sf_dir, run)
    return log.select("trade_id", "symbol", "price", "quantity", "trade_time", "is_buyer_maker",
                      "fraud_score", "is_fraud", "threshold")


@register("m2_running_totals_stream", V.with_(V.PREDICTIONS) + """
SELECT count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS flagged,
       round(CAST(sum(is_fraud) AS DOUBLE) / count(*), 6) AS flag_rate FROM predictions""")
def m2_running_totals_stream(spark, sf_dir):
    return r6(streams.running_totals_stream(spark, sf_dir))


@register("m3_volume_stream", ORACLE["a11_volume_5s"])
def m3_volume_stream(spark, sf_dir):
    v = streams.volume_stream(spark, sf_dir)
    return r6(v.select(ts_text("bucket_start"), "total", "fraud", "avg_score"))


_HOUR_SQL = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f')"


@register("m3_late_rows", V.with_(V.DASHBOARD) + f"""
SELECT {_HOUR_SQL} AS hour, count(*) AS n_in, CAST(sum(is_fraud) AS BIGINT) AS fraud, true AS some_late
FROM dash GROUP BY 1""")
def m3_late_rows(spark, sf_dir):
    """Files that hold rows of all times under a watermark of an hour: what the
    buckets count and what the side table of late rows holds make up the log.
    (Which rows are late depends on the order of the files.)"""
    buckets, late = streams.volume_with_late_rows(spark, sf_dir)
    kept = buckets.select(F.date_trunc("hour", "bucket_start").alias("at"), "total", "fraud", F.lit(0).alias("n_late"))
    behind = late.select(F.date_trunc("hour", "ts").alias("at"), F.lit(1).alias("total"),
                         F.col("is_fraud").alias("fraud"), F.lit(1).alias("n_late"))
    both = kept.unionByName(behind).groupBy("at").agg(
        F.sum("total").alias("n_in"), F.sum("fraud").alias("fraud"))
    some = behind.agg((F.count(F.lit(1)) > 0).alias("some_late"))
    return both.join(F.broadcast(some)).select(ts_text("at", "hour"), "n_in", "fraud", "some_late")


def _m4(spark, sf_dir, key, digits=6, **options):
    d = streams.count_window_stream(spark, sf_dir, key, **options)
    return d.select(key, "window_no", ts_text("ts"),
                    *[rnd(F.col(c), digits).alias(c) for c in ("drift_score", "mean_score", "std_score")], "window_size")


@register("m4_count_window_drift_stream", _d5_sql("is_buyer_maker"))
def m4_count_window_drift_stream(spark, sf_dir):
    return _m4(spark, sf_dir, "is_buyer_maker")


@register("m4_count_window_drift_by_symbol", _d5_sql("symbol", 10, 9))
def m4_count_window_drift_by_symbol(spark, sf_dir):
    """M4 + M5 per symbol, windows of ten scores: rows from unordered files
    wait in the symbol's state and are released in event-time order. Compared
    to nine digits: the mean of ten scores of six digits has seven, so six would
    leave ties to the order of the sums."""
    return _m4(spark, sf_dir, "symbol", digits=9, n=10)


_DRIFT_SCHEMA = ("symbol string, window_no bigint, ts timestamp, drift_score double, mean_score double, "
                 "std_score double, window_size int")


@register("k9_drift_sink_compacted", _d5_sql("symbol", 10, 9))
def k9_drift_sink_compacted(spark, sf_dir):
    """K9: M4's rows written by micro-batch, the days before the 20th merged
    into few files, read as one table."""
    path = streams.drift_sink(spark, sf_dir)
    sinks.compact_flushes(spark, path, path + "-merged", _DRIFT_SCHEMA, until=_dt.date(2024, 1, 20))
    d = sinks.read_flushes(spark, path, path + "-merged", _DRIFT_SCHEMA)
    return d.select("symbol", "window_no", ts_text("ts"),
                    *[rnd(F.col(c), 9).alias(c) for c in ("drift_score", "mean_score", "std_score")], "window_size")


# ── sources and sinks (S1, S3, S4, S5, K1, K10) ─────────────────────────────

from vigil.sources import readers, sinks  # noqa: E402

_TX_SCHEMA = ("TransactionID bigint, TransactionDT bigint, TransactionAmt double, ProductCD string, "
              "card4 string, card1 double, acct_balance double, isFraud int")


@register("s1_read_transactions", V.with_(V.TRANSACTIONS) + "SELECT * FROM transactions")
def s1_read_transactions(spark, sf_dir):
    """CSV with header written from the transactions adapter (K8 path), read
    back with the explicit schema."""
    path = streams.scratch(spark, "s1")
    tables.transactions(spark, sf_dir).write.option("header", "true").csv(path)
    return readers.read_transactions(spark, path, schema=_TX_SCHEMA)


@register("s3_sample_head", V.with_(V.TRANSACTIONS) + "SELECT * FROM transactions ORDER BY TransactionID LIMIT 1000")
def s3_sample_head(spark, sf_dir):
    return readers.sample_head(tables.transactions(spark, sf_dir), 1000, ["TransactionID"])


def _logs(spark, sf_dir) -> str:
    path = streams.scratch(spark, "logs")
    sinks.write_prediction_log(tables.predictions(spark, sf_dir), path)
    return path


@register("s4_read_prediction_logs", V.with_(V.PREDICTIONS) + f"""
SELECT id AS trade_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, symbol, fraud_score, is_fraud
FROM predictions WHERE ts >= {NOW_SQL} - INTERVAL 8 DAY AND ts <= {NOW_SQL}""")
def s4_read_prediction_logs(spark, sf_dir):
    logs = readers.read_prediction_logs(spark, _logs(spark, sf_dir), since=B_START, until=NOW)
    return logs.select("trade_id", ts_text("ts"), "symbol", "fraud_score", "is_fraud")


@register("s4_mixed_layouts", V.with_(V.PREDICTIONS) + f"""
SELECT id AS trade_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CASE WHEN id % 3 <> 2 THEN symbol END AS symbol,
       fraud_score, is_fraud, CASE WHEN id % 3 <> 2 THEN threshold END AS threshold
FROM predictions WHERE ts >= {NOW_SQL} - INTERVAL 8 DAY AND ts <= {NOW_SQL}""")
def s4_mixed_layouts(spark, sf_dir):
    """Logs of three writers: the usual columns; other order and two columns
    more; two columns fewer. Read by name through the header catalogue."""
    path = streams.scratch(spark, "mixed-logs")
    log = tables.predictions(spark, sf_dir)
    part = F.pmod(F.col("id"), F.lit(3))
    sinks.write_prediction_log(log.where(part == 0), path)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    day = F.to_date("ts").alias("dt")
    for rows in (
            log.where(part == 1).select(F.lit("v2").alias("model_version"), "threshold", "is_fraud", "fraud_score", stamp,
                                        "symbol", F.col("id").alias("trade_id"), F.lit(7).alias("latency_ms"), day),
            log.where(part == 2).select(stamp, F.col("id").alias("trade_id"), "fraud_score", "is_fraud", day)):
        rows.write.mode("append").option("header", "true").partitionBy("dt").csv(path)
    logs = readers.read_prediction_logs(spark, path, since=B_START, until=NOW, catalog=path + "-catalog")
    return logs.select("trade_id", ts_text("ts"), "symbol", "fraud_score", "is_fraud", "threshold")


@register("s5_recent_predictions", V.with_(V.PREDICTIONS) + f"""
SELECT count(*) AS n_predictions, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate,
       round(avg(fraud_score), 6) AS avg_score, round(avg(price * quantity), 6) AS transaction_amt_mean,
       round(avg(CAST(hour(ts) AS DOUBLE)), 6) AS hour_of_day_mean
FROM predictions WHERE ts > {NOW_SQL} - INTERVAL 24 HOUR AND ts <= {NOW_SQL}""")
def s5_recent_predictions(spark, sf_dir):
    logs = readers.read_prediction_logs(spark, _logs(spark, sf_dir), since=W_START, until=NOW, strict=True)
    typed = logs.select("ts", "is_fraud", "fraud_score", F.col("price").cast("double").alias("price"),
                        F.col("quantity").cast("double").alias("quantity"))
    return r6(drift.recent_stats(typed))


_BASE_FEATS = ["TransactionAmt", "card1", "acct_balance"]


@register("k10_baseline_histogram", V.with_(V.TRANSACTIONS) + """,
bothv AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS v FROM transactions WHERE {c} IS NOT NULL AND NOT isnan({c})"
    for c in _BASE_FEATS) + f"""),
r AS (SELECT feature, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS step FROM bothv GROUP BY feature)
SELECT b.feature, CAST({_bin_sql('v', 10)} AS INTEGER) AS bin, count(*) AS n
FROM bothv b JOIN r ON b.feature = r.feature GROUP BY ALL""")
def k10_baseline_histogram(spark, sf_dir):
    _, hist = sinks.baseline_tables(tables.transactions(spark, sf_dir), _BASE_FEATS)
    return hist.select("feature", "bin", "n")


def _baseline(spark, sf_dir):
    """K10 written, then read: (moments, histogram, live rows)."""
    recent, base = _windows(spark, sf_dir)
    path = streams.scratch(spark, "baseline")
    sinks.cache_baseline(base, MONITORED, path)
    return *readers.read_baseline(spark, path), recent


@register("k10_psi_from_baseline", FEATS_SQL + """,
e AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM base WHERE {c} IS NOT NULL AND NOT isnan({c})"
                               for c in MONITORED) + """),
a AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM recent WHERE {c} IS NOT NULL AND NOT isnan({c})"
                               for c in MONITORED) + f"""),
r AS (SELECT feature, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS step FROM e GROUP BY feature),
g AS (SELECT feature, 'e' AS side, {_bin_sql('v', 10)} AS bin FROM e JOIN r USING (feature)
      UNION ALL
      SELECT feature, 'a', CASE WHEN v < lo THEN 0 WHEN v > hi THEN 9 ELSE {_bin_sql('v', 10)} END FROM a JOIN r USING (feature)),
c AS (SELECT feature, bin, count(*) FILTER (WHERE side = 'e') AS e_c, count(*) FILTER (WHERE side = 'a') AS a_c
      FROM g GROUP BY ALL),
t AS (SELECT feature, sum(e_c) AS e_n, sum(a_c) AS a_n FROM c GROUP BY feature),
p AS (SELECT t.feature, e_n, a_n, (coalesce(e_c, 0) + 1e-6) / (e_n + 1e-5) AS e_p, (coalesce(a_c, 0) + 1e-6) / (a_n + 1e-5) AS a_p
      FROM t CROSS JOIN range(0, 10) k LEFT JOIN c ON c.feature = t.feature AND c.bin = k.range),
s AS (SELECT feature, CAST(any_value(e_n) AS BIGINT) AS expected_n, CAST(any_value(a_n) AS BIGINT) AS actual_n,
             sum((a_p - e_p) * ln(a_p / e_p)) AS psi FROM p GROUP BY feature)
SELECT feature, CASE WHEN expected_n > 0 AND actual_n > 0 THEN round(psi, 6) END AS psi, expected_n, actual_n,
       CASE WHEN expected_n = 0 OR actual_n = 0 THEN NULL WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'minor'
            ELSE 'significant' END AS psi_band
FROM s""")
def k10_psi_from_baseline(spark, sf_dir):
    """D3 of the last day against the stored histogram; the baseline's rows are
    read once, when it is written."""
    _, histogram, recent = _baseline(spark, sf_dir)
    return r6(drift.psi_from_baseline(histogram, recent, MONITORED))


@register("k10_zscore_from_baseline", FEATS_SQL + f""",
r AS ({_moments_sql('recent', 'recent')}),
b AS ({_moments_sql('base', 'base')})
SELECT r.feature, round(abs(recent_mean - base_mean) / base_std, 4) AS z,
       round(abs(recent_mean - base_mean) / base_std, 4) > 3.0 AS shifted
FROM r JOIN b ON r.feature = b.feature
WHERE recent_mean IS NOT NULL AND base_mean IS NOT NULL AND base_std IS NOT NULL AND base_std <> 0""")
def k10_zscore_from_baseline(spark, sf_dir):
    moments, _, recent = _baseline(spark, sf_dir)
    out = drift.zscore_from_baseline(moments, recent, MONITORED)
    return out.select("feature", rnd(F.col("z"), 4).alias("z"), "shifted")


@register("k1_compacted_log", V.with_(V.PREDICTIONS) + """
SELECT id AS trade_id, symbol, round(fraud_score, 6) AS fraud_score, is_fraud FROM predictions""")
def k1_compacted_log(spark, sf_dir):
    """Flushes of the log by day and batch, days up to the 15th merged; then
    flushes that arrive late in a merged day, read beside it until the next
    run."""
    path, merged = streams.scratch(spark, "flushes"), streams.scratch(spark, "merged")
    schema = "trade_id bigint, symbol string, fraud_score double, is_fraud int"
    log = tables.predictions(spark, sf_dir).select(
        F.col("id").alias("trade_id"), "symbol", "fraud_score", "is_fraud", F.to_date("ts").alias("dt"),
        F.lit("0").alias("run"), F.pmod("id", F.lit(4)).cast("bigint").alias("batch"))
    put = lambda rows: (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                        .partitionBy("dt", "run", "batch").parquet(path))
    put(log.where("batch < 3"))
    sinks.compact_flushes(spark, path, merged, schema, until=_dt.date(2024, 1, 15))
    put(log.where("batch = 3"))
    return r6(sinks.read_flushes(spark, path, merged, schema).drop("dt"))


# K4/K6/K8 write to the shared checkpoint folder and read back: the oracle is
# the SQL of the table written (F7's matrix without the id; J1's merge).
_F7_NO_ID_SQL = f"SELECT * EXCLUDE (TransactionID) FROM ({ORACLE['f7_apply_features']})"


def _fitted_matrix(spark, sf_dir):
    t = tables.transactions(spark, sf_dir)
    m = feat.fit_features(t, label="isFraud")
    return m, m.transform(t)


@register("k4_write_features", _F7_NO_ID_SQL)
def k4_write_features(spark, sf_dir):
    """Feature columns in training order, label last, as parquet."""
    m, matrix = _fitted_matrix(spark, sf_dir)
    path = streams.scratch(spark, "k4")
    sinks.write_features(matrix, m.feature_cols, "isFraud", path)
    return r6(spark.read.parquet(path))


@register("k6_export_label_first", _F7_NO_ID_SQL)
def k6_export_label_first(spark, sf_dir):
    """Headerless CSV with the label first, read back by position."""
    m, matrix = _fitted_matrix(spark, sf_dir)
    path = streams.scratch(spark, "k6")
    sinks.export_label_first(matrix, m.feature_cols, "isFraud", path)
    schema = ", ".join(["isFraud int"] + [f"{c} double" for c in m.feature_cols])
    return r6(spark.read.schema(schema).option("header", "false").csv(path))


@register("k8_write_merged", ORACLE["j1_merge_identity"])
def k8_write_merged(spark, sf_dir):
    merged = joins.merge_identity(tables.document_rows(spark, sf_dir),
                                  tables.identity(spark, sf_dir), key="doc_id")
    path = streams.scratch(spark, "k8")
    sinks.write_merged(merged, path)
    return spark.read.parquet(path)


# K7 + S8: the daily drift job over the whole log (D1 as of every midnight
# from the first full day to NOW), appended to the reports dataset, then the
# latest 20 drift reports.
FIRST_DAY = _dt.date(2024, 1, 2)


@register("s8_latest_drift_reports", V.with_(V.PREDICTIONS) + f""",
days AS (SELECT d AS as_of FROM range(TIMESTAMP '{FIRST_DAY} 00:00:00', {NOW_SQL} + INTERVAL 1 DAY,
                                      INTERVAL 1 DAY) t(d)),
j AS (SELECT days.as_of, p.fraud_score, p.ts >= days.as_of - INTERVAL 24 HOUR AS w
      FROM days JOIN predictions p ON p.ts >= days.as_of - INTERVAL 8 DAY AND p.ts <= days.as_of
      WHERE p.fraud_score IS NULL OR p.fraud_score >= 0),
s AS (SELECT as_of, count(fraud_score) FILTER (WHERE w) AS window_n,
             avg(fraud_score) FILTER (WHERE w) AS window_mean,
             count(fraud_score) FILTER (WHERE NOT w) AS baseline_n,
             avg(fraud_score) FILTER (WHERE NOT w) AS baseline_mean
      FROM j GROUP BY as_of),
d AS (SELECT *, CASE WHEN window_n >= 50 AND baseline_n >= 50
                     THEN abs(window_mean - baseline_mean) END AS drift FROM s)
SELECT {SQL_TS.format(c='as_of')} AS as_of, window_n, baseline_n,
       round(window_mean, 6) AS window_mean, round(baseline_mean, 6) AS baseline_mean,
       round(drift, 6) AS drift_score, coalesce(drift > 0.05, false) AS drift_detected,
       CASE WHEN drift > 0.05 THEN 'drift_detected' ELSE 'no_drift' END AS decision
FROM d ORDER BY as_of DESC LIMIT 20""")
def s8_latest_drift_reports(spark, sf_dir):
    daily = drift.drift_decision(drift.daily_mean_shift_drift(
        tables.predictions(spark, sf_dir), FIRST_DAY, NOW.date()))
    path = streams.scratch(spark, "k7")
    sinks.append_report(daily.withColumn("as_of", ts_text("as_of")), path, "drift")
    reports = readers.read_reports(spark, path, "drift", "as_of string, window_n bigint, baseline_n bigint, "
                                   "window_mean double, baseline_mean double, drift_score double, "
                                   "drift_detected boolean, decision string")
    latest = readers.latest_reports(reports, 20, "as_of")
    return r6(latest.select("as_of", "window_n", "baseline_n", "window_mean", "baseline_mean",
                            "drift_score", "drift_detected", "decision"))


# ── small operators with their own queries (A5, P4, W2, S2, K2) ─────────────

from vigil.functions.scalars import flag as _flag  # noqa: E402
from vigil.operators.sequence import prefix_sums as _prefix_sums  # noqa: E402


@register("a5_score_stats", V.with_(V.DASHBOARD) + """
SELECT is_buyer_maker, round(avg(fraud_score), 6) AS score_mean, round(stddev_samp(fraud_score), 6) AS score_std,
       round(min(fraud_score), 6) AS score_min, round(max(fraud_score), 6) AS score_max,
       count(fraud_score) AS score_n
FROM dash GROUP BY is_buyer_maker""")
def a5_score_stats(spark, sf_dir):
    d = tables.dashboard_predictions(spark, sf_dir)
    return r6(d.groupBy("is_buyer_maker").agg(*drift.score_stats(F.col("fraud_score"), "score")))


@register("p4_flag_at_threshold", V.with_(V.PREDICTIONS) + """
SELECT id, fraud_score, CASE WHEN fraud_score >= 0.3 AND fraud_score <> -1 THEN 1 ELSE 0 END AS flagged
FROM predictions""")
def p4_flag_at_threshold(spark, sf_dir):
    p = tables.predictions(spark, sf_dir)
    return p.select("id", "fraud_score", _flag("fraud_score", 0.3).alias("flagged"))


@register("w2_running_moments", V.with_(V.DASHBOARD) + """,
d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(fraud_score) AS s FROM dash GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, n,
       CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS n_so_far,
       round(sum(s) OVER (ORDER BY day) / sum(n) OVER (ORDER BY day), 6) AS mean_so_far
FROM d""")
def w2_running_moments(spark, sf_dir):
    """Running count and mean of successful scores by day (distributed
    prefix sums over the daily table)."""
    d = tables.dashboard_predictions(spark, sf_dir)
    daily = d.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"),
                                                         F.sum("fraud_score").alias("s"))
    run = _prefix_sums(daily, ["day"], {"n_so_far": F.col("n"), "s_so_far": F.col("s")})
    return r6(run.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "n_so_far",
                         (F.col("s_so_far") / F.col("n_so_far")).alias("mean_so_far")))


@register("s2_read_columns", V.with_(V.PREDICTIONS) + "SELECT id, fraud_score FROM predictions")
def s2_read_columns(spark, sf_dir):
    return readers.read_columns(tables.predictions(spark, sf_dir), ["id", "not_logged", "fraud_score"])


@register("k2_publish_trades", V.with_(V.PREDICTIONS) + """
SELECT symbol AS key, id AS trade_id, symbol, price, quantity, trade_time AS trade_ms, is_buyer_maker, 'binance' AS source
FROM predictions""")
def k2_publish_trades(spark, sf_dir):
    """The published messages, read back field by field."""
    out, _quarantine = trd.publish_frame(tables.trade_json(spark, sf_dir).select("value"))
    at = lambda path, kind: F.get_json_object("value", f"$.{path}").cast(kind)
    return out.select(F.col("key").cast("string").alias("key"), at("t", "bigint").alias("trade_id"),
                      at("s", "string").alias("symbol"), at("p", "double").alias("price"),
                      at("q", "double").alias("quantity"), at("T", "bigint").alias("trade_ms"),
                      at("m", "boolean").alias("is_buyer_maker"), at("source", "string").alias("source"))


# A scorer with given coefficients over the features a trade has, so that the
# whole stream can be compared with SQL.
_LINEAR = tr.LinearScorer({"TransactionAmt": 0.9, "hour_of_day": -0.05, "day_of_week": 0.1}, -4.5)
_LINEAR_FEATURES = ["TransactionAmt", "card1", "day_of_week", "hour_of_day"]
_LINEAR_MEANS = {"TransactionAmt": 4.0, "card1": 0.0, "day_of_week": 3.0, "hour_of_day": 11.5}
_LINEAR_STDS = {"TransactionAmt": 1.5, "card1": 1.0, "day_of_week": 2.0, "hour_of_day": 7.0}
_BROKEN_EVERY = 10             # every tenth message is cut short in the quarantine query


def _linear_features(spark):
    return feat.FeatureModel(
        label="isFraud", feature_cols=_LINEAR_FEATURES, dropped=[], unlisted_strings=[],
        log_transform_cols=["TransactionAmt"], categorical_cols=[],
        encoders=spark.createDataFrame([], feat.ENCODER_SCHEMA), means=_LINEAR_MEANS, stds=_LINEAR_STDS,
        class_weight=None)


_SCORED = V.PREDICTIONS + """,
raw AS (SELECT *, ln(1 + price * quantity) AS amt, CAST(hour(ts) AS DOUBLE) AS h, CAST(isodow(ts) - 1 AS DOUBLE) AS w
        FROM predictions),
scored AS (SELECT id AS trade_id, symbol, price, quantity, trade_time, is_buyer_maker, ts, amt, h, w,
                  round(1 / (1 + exp(-(-4.5 + 0.9 * amt - 0.05 * h + 0.1 * w))), 6) AS fraud_score FROM raw)"""


@register("t9_top_deviations", V.with_(_SCORED) + """,
dev AS (
  SELECT trade_id, 'TransactionAmt' AS feature, amt AS value, abs((amt - 4.0) / 1.5) AS deviation FROM scored WHERE fraud_score >= 0.5
  UNION ALL SELECT trade_id, 'hour_of_day', h, abs((h - 11.5) / 7.0) FROM scored WHERE fraud_score >= 0.5
  UNION ALL SELECT trade_id, 'day_of_week', w, abs((w - 3.0) / 2.0) FROM scored WHERE fraud_score >= 0.5),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY deviation DESC, feature DESC) AS place FROM dev)
SELECT trade_id, place, feature, round(value, 6) AS value, round(deviation, 6) AS deviation FROM ranked WHERE place <= 2""")
def t9_top_deviations(spark, sf_dir):
    """The two most deviating features of every flagged live trade, by given
    means and spreads, one row per feature (``card1`` is filled in trades, so it
    never counts)."""
    scored = scoring.score_trades(tables.trade_json(spark, sf_dir), _linear_features(spark), _LINEAR)
    told = tr.top_deviations(scored.where(F.col("is_fraud") == 1), _LINEAR_FEATURES, 2, _LINEAR_MEANS, _LINEAR_STDS,
                             values="features")
    rows = told.select("trade_id", F.posexplode("top_deviations").alias("pos", "d"))
    return rows.select("trade_id", (F.col("pos") + 1).cast("bigint").alias("place"), "d.feature",
                       rnd(F.col("d.value"), 6).alias("value"), rnd(F.col("d.deviation"), 6).alias("deviation"))


@register("m1_scored_log", V.with_(_SCORED) + """
SELECT trade_id, symbol, price, quantity, trade_time, is_buyer_maker,
       fraud_score, CAST(fraud_score >= 0.5 AS INTEGER) AS is_fraud, CAST(0.5 AS DOUBLE) AS threshold FROM scored""")
def m1_scored_log(spark, sf_dir):
    """M1 with given coefficients; its log through the drift job's reader."""
    base = streams.score_events(spark, sf_dir, _linear_features(spark), _LINEAR)
    log = readers.read_prediction_logs(spark, base + "/log", fmt="parquet")
    return log.select("trade_id", "symbol", F.col("price").cast("double").alias("price"),
                      F.col("quantity").cast("double").alias("quantity"), "trade_time", "is_buyer_maker",
                      rnd(F.col("fraud_score")).alias("fraud_score"), "is_fraud", "threshold")


@register("c_stream_log_to_drift", _d1_sql(0.05).replace(
    V.with_(V.PREDICTIONS), V.with_(_SCORED.replace("predictions AS (", "base AS (", 1).replace(
        "FROM predictions)", "FROM base)") + """,
predictions AS (SELECT ts, fraud_score, CAST(fraud_score >= 0.5 AS INTEGER) AS is_fraud FROM scored)""")))
def c_stream_log_to_drift(spark, sf_dir):
    """Events streamed through M1, then the drift decision over that log."""
    base = streams.score_events(spark, sf_dir, _linear_features(spark), _LINEAR)
    log = readers.read_prediction_logs(spark, base + "/log", since=B_START, until=NOW, fmt="parquet")
    return r6(drift.mean_shift_drift(log, NOW))


@register("k2_quarantine", V.with_(V.PREDICTIONS) + f"""
SELECT count(*) AS n_in, count(*) FILTER (WHERE id % {_BROKEN_EVERY} <> 0) AS n_scored,
       count(*) FILTER (WHERE id % {_BROKEN_EVERY} = 0) AS n_quarantined FROM predictions""")
def k2_quarantine(spark, sf_dir):
    """Every message ends in the log or in the quarantine, also with dedup on."""
    good = tables.trades(spark, sf_dir).select("trade_id").where(f"trade_id % {_BROKEN_EVERY} = 0").select(
        F.concat(F.lit('{"t": '), F.col("trade_id").cast("string")).alias("value"))
    whole = trd.parse_trades(tables.trade_json(spark, sf_dir).select("value")).where(
        f"trade_id % {_BROKEN_EVERY} <> 0").select("value")
    messages = whole.unionByName(good)
    base = streams.score_events(spark, sf_dir, _linear_features(spark), _LINEAR, messages=messages,
                                dedup_watermark="1 hour")
    log = spark.read.parquet(base + "/log").agg(F.count(F.lit(1)).alias("n_scored")).withColumn("_k", F.lit(0))
    bad = spark.read.parquet(base + "/quarantine").agg(F.count(F.lit(1)).alias("n_quarantined")).withColumn("_k", F.lit(0))
    asked = messages.agg(F.count(F.lit(1)).alias("n_in")).withColumn("_k", F.lit(0))
    return asked.join(log, "_k").join(bad, "_k").drop("_k")


@register("k3_alerts", V.with_(_SCORED) + """
SELECT trade_id, feature, round(deviation, 6) AS deviation, k AS place FROM (
  SELECT trade_id, feature, deviation, row_number() OVER (PARTITION BY trade_id ORDER BY deviation DESC, feature DESC) AS k
  FROM (SELECT trade_id, 'TransactionAmt' AS feature, abs((amt - 4.0) / 1.5) AS deviation FROM scored WHERE fraud_score >= 0.5
        UNION ALL SELECT trade_id, 'day_of_week', abs((w - 3.0) / 2.0) FROM scored WHERE fraud_score >= 0.5
        UNION ALL SELECT trade_id, 'hour_of_day', abs((h - 11.5) / 7.0) FROM scored WHERE fraud_score >= 0.5))""")
def k3_alerts(spark, sf_dir):
    """Alerts of the stream: the features of a flagged trade by deviation; the
    filled ones (card1) are never among them."""
    base = streams.score_events(spark, sf_dir, _linear_features(spark), _LINEAR)
    alerts = spark.read.parquet(base + "/alerts")
    items = alerts.select("trade_id", F.posexplode("top_deviations").alias("pos", "d"))
    return items.select("trade_id", "d.feature", rnd(F.col("d.deviation")).alias("deviation"),
                        (F.col("pos") + 1).cast("bigint").alias("place"))


@register("f3_encode_many_values", V.with_(V.TRANSACTIONS) + """
SELECT TransactionID, CAST(row_number() OVER (ORDER BY CAST(TransactionID AS VARCHAR)) - 1 AS DOUBLE) AS code FROM transactions""")
def f3_encode_many_values(spark, sf_dir):
    """F3/J4 with as many values as rows: encoders are a table throughout."""
    t = tables.transactions(spark, sf_dir).select("TransactionID", F.col("TransactionID").cast("string").alias("code"))
    return feat.join_encoders(t, feat.fit_encoders(t, ["code"]), ["code"])


# ── entry C: the daily drift job over written logs ──────────────────────────

from vigil.plans import drift_job  # noqa: E402


@register("d6_daily_drift_job", f"""
SELECT *, CASE WHEN drift_score IS NOT NULL AND drift_detected THEN 'drift_detected'
               ELSE 'no_drift' END AS decision
FROM ({_d1_sql(0.05)})""")
def d6_daily_drift_job(spark, sf_dir):
    """Logs written date-partitioned (K1), read back by range (S4), D1 + D6,
    reports appended (K7)."""
    logs = _logs(spark, sf_dir)
    res = drift_job.run_drift_job(spark, logs, streams.scratch(spark, "reports"), NOW)
    return r6(res)
