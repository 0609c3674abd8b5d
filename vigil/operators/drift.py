"""Drift operators and the score statistics they use.

All of them are grouped: ``by=[...]`` (symbol, segment, model version); the
global case is ``by=[]``. Each is one scan with conditional aggregates, so the
shuffle is partial-aggregated (map-side combine) and carries one row per
group and partition.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.bins import equal_width_bin
from vigil.functions.scalars import psi_band, round_half_even_exact, severity
from vigil.operators.sequence import prefix_sums

# Fixed values of the reference's drift jobs.
DRIFT_THRESHOLD = 0.05          # |Δ mean score| that counts as drift
MIN_PREDICTIONS = 50            # below this on either side no score is computed
WINDOW_HOURS = 24
BASELINE_DAYS = 7
Z_THRESHOLD = 3.0               # feature mean shift in baseline standard deviations
RATE_CHANGE_THRESHOLD = 0.05    # flag-rate change that counts as drift
DEFAULT_BASELINE_RATE = 0.035   # baseline label rate when none is known
PSI_EPSILON = 1e-6
PSI_BINS = 10
COUNT_WINDOW = 50               # count-window size of the live monitor
STD_FLOOR = 1e-6                # population std of 0 is replaced by this
ALERT_TYPE = "FRAUD_SCORE_DRIFT"
ALERT_ACTION = "Model retraining has been triggered automatically."


def _ts_literal(value, data_type) -> Column:
    """A literal of the column's own timestamp type, so the comparison is
    pushed into the parquet scan instead of casting every row."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast(data_type)


def score_stats(scores: Column, prefix: str) -> list[Column]:
    """A5: mean, sample std, min, max and non-null count of ``scores``."""
    return [
        F.avg(scores).alias(f"{prefix}_mean"),
        F.stddev_samp(scores).alias(f"{prefix}_std"),
        F.min(scores).alias(f"{prefix}_min"),
        F.max(scores).alias(f"{prefix}_max"),
        F.count(scores).alias(f"{prefix}_n"),
    ]


def flag_rate(df: DataFrame, flag_col: str = "is_fraud", by=()) -> DataFrame:
    """Mean of the flag (NULL on empty input)."""
    return df.groupBy(*by).agg(F.avg(F.col(flag_col).cast("double")).alias("flag_rate"))


def mean_shift_drift(log: DataFrame, now, window_hours: float = WINDOW_HOURS,
                     baseline_days: float = BASELINE_DAYS, threshold: float = DRIFT_THRESHOLD,
                     min_n: int = MIN_PREDICTIONS, by=(), exclude_failed: bool = True,
                     score_col: str = "fraud_score", ts_col: str = "ts",
                     flag_col: str = "is_fraud") -> DataFrame:
    """D1 (+J2, A5, A8): last ``window_hours`` before ``now`` against the
    ``baseline_days`` before that, half-open: baseline ``[s, e)``, window
    ``[e, now]``. One scan; the two sides are conditional aggregates."""
    if isinstance(now, str):
        now = _dt.datetime.fromisoformat(now)
    w_start = now - _dt.timedelta(hours=window_hours)
    b_start = w_start - _dt.timedelta(days=baseline_days)
    ts_type = log.schema[ts_col].dataType
    ts = F.col(ts_col)
    lo, mid, hi = (_ts_literal(x, ts_type) for x in (b_start, w_start, now))
    df = log.where((ts >= lo) & (ts <= hi))
    if exclude_failed:
        df = df.where(F.col(score_col).isNull() | (F.col(score_col) >= 0))
    return _shift_by_period(df, ts >= mid, list(by), threshold, min_n, window_hours, baseline_days,
                            score_col, flag_col)


def _shift_by_period(df: DataFrame, in_window: Column, by: list, threshold: float, min_n: int,
                     window_hours: float, baseline_days: float, score_col: str,
                     flag_col: str) -> DataFrame:
    """D1's one grouped aggregation: window and baseline are conditional
    aggregates of the same scan (partial aggregation before the shuffle)."""
    score = F.col(score_col).cast("double")
    flag = F.col(flag_col).cast("double")
    agg = df.groupBy(*by).agg(
        *score_stats(F.when(in_window, score), "window"),
        *score_stats(F.when(~in_window, score), "baseline"),
        F.avg(F.when(in_window, flag)).alias("window_flag_rate"),
        F.avg(F.when(~in_window, flag)).alias("baseline_flag_rate"),
    )
    enough = (F.col("window_n") >= min_n) & (F.col("baseline_n") >= min_n)
    drift = F.when(enough, F.abs(F.col("window_mean") - F.col("baseline_mean")))
    return agg.select(
        *by,
        "window_n", "window_mean", "window_std", "window_min", "window_max",
        "baseline_n", "baseline_mean", "baseline_std", "baseline_min", "baseline_max",
        "window_flag_rate", "baseline_flag_rate",
        drift.alias("drift_score"),
        F.coalesce(drift > threshold, F.lit(False)).alias("drift_detected"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(float(window_hours)).alias("window_hours"),
        F.lit(float(baseline_days)).alias("baseline_days"),
    )


def daily_mean_shift_drift(log: DataFrame, first_day, last_day, window_hours: float = WINDOW_HOURS,
                           baseline_days: float = BASELINE_DAYS, threshold: float = DRIFT_THRESHOLD,
                           min_n: int = MIN_PREDICTIONS, by=(), exclude_failed: bool = True,
                           score_col: str = "fraud_score", ts_col: str = "ts",
                           flag_col: str = "is_fraud") -> DataFrame:
    """D1 as of every midnight from ``first_day`` to ``last_day`` — the
    daily drift job over a history, one ``as_of`` row per day (and group).

    Each row is copied to the as-of days whose range ``[as_of − window −
    baseline, as_of]`` holds it: at most ⌈range/1 day⌉ + 1 copies, a bounded
    expansion inside the task, never a join of days with rows. Then D1's
    conditional aggregates grouped by ``as_of``. Without groups every day has a
    row; one whose range holds no row of the log reports no scores and no
    drift, as D1 does. With groups, a group has rows for its own days."""
    first_day = _dt.date.fromisoformat(first_day) if isinstance(first_day, str) else first_day
    last_day = _dt.date.fromisoformat(last_day) if isinstance(last_day, str) else last_day
    if isinstance(first_day, _dt.datetime):
        first_day = first_day.date()
    if isinstance(last_day, _dt.datetime):
        last_day = last_day.date()
    span_s = window_hours * 3600 + baseline_days * 86400
    ts_type = log.schema[ts_col].dataType
    ts = F.col(ts_col)
    lo = _ts_literal(_dt.datetime.combine(first_day, _dt.time()) - _dt.timedelta(seconds=span_s), ts_type)
    hi = _ts_literal(_dt.datetime.combine(last_day, _dt.time()), ts_type)
    df = log.where((ts >= lo) & (ts <= hi))
    if exclude_failed:
        df = df.where(F.col(score_col).isNull() | (F.col(score_col) >= 0))
    day = F.to_date(ts)
    start = F.greatest(F.when(ts == day.cast(ts_type), day).otherwise(F.date_add(day, 1)),
                       F.lit(first_day))
    end = F.least(F.to_date(ts + F.expr(f"make_dt_interval(0, 0, 0, {float(span_s)})")),
                  F.lit(last_day))
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    as_of = F.col("as_of")
    expanded = (df.select(*by, ts_col, score_col, flag_col, F.explode(days).alias("_day"))
                .withColumn("as_of", F.col("_day").cast(ts_type)))
    w_start = as_of - F.expr(f"make_dt_interval(0, 0, 0, {float(window_hours * 3600)})")
    out = _shift_by_period(expanded, F.col(ts_col) >= w_start, [*by, "as_of"], threshold, min_n,
                           window_hours, baseline_days, score_col, flag_col)
    if by or last_day < first_day:
        return out
    days = log.sparkSession.range((last_day - first_day).days + 1).select(
        F.date_add(F.lit(first_day), F.col("id").cast("int")).cast(ts_type).alias("as_of"))
    fill = {"window_n": F.lit(0).cast("bigint"), "baseline_n": F.lit(0).cast("bigint"),
            "drift_detected": F.lit(False), "threshold": F.lit(float(threshold)),
            "window_hours": F.lit(float(window_hours)), "baseline_days": F.lit(float(baseline_days))}
    full = days.join(out, "as_of", "left")
    return full.select(*[F.coalesce(F.col(c), fill[c]).alias(c) if c in fill else F.col(c) for c in out.columns])


def drift_decision(result: DataFrame) -> DataFrame:
    """NULL score → no drift; otherwise the detected flag decides."""
    detected = F.col("drift_score").isNotNull() & F.col("drift_detected")
    return result.withColumn(
        "decision", F.when(detected, "drift_detected").otherwise("no_drift"))


def drift_alert(result: DataFrame, keep=()) -> DataFrame:
    """One alert row per group whose drift was detected; ``keep`` copies
    result columns next to the alert fields."""
    fired = result.where(F.col("drift_score").isNotNull() & F.col("drift_detected"))
    msg = F.format_string(
        "Fraud score drift detected. Window mean=%.6f, Baseline mean=%.6f, "
        "Drift=%.6f (threshold=%s).",
        F.col("window_mean"), F.col("baseline_mean"), F.col("drift_score"),
        F.col("threshold").cast("string"))
    key_cols = [c for c in result.columns if c not in _D1_COLS]
    return fired.select(
        *key_cols, *keep,
        F.lit(ALERT_TYPE).alias("alert_type"),
        severity("drift_score", F.col("threshold")).alias("severity"),
        msg.alias("message"),
        F.lit(ALERT_ACTION).alias("action"),
        F.to_json(F.struct(*[F.col(c) for c in _D1_COLS if c in result.columns])).alias("drift_result"),
    )


_D1_COLS = ["window_n", "window_mean", "window_std", "window_min", "window_max",
            "baseline_n", "baseline_mean", "baseline_std", "baseline_min", "baseline_max",
            "window_flag_rate", "baseline_flag_rate", "drift_score", "drift_detected",
            "threshold", "window_hours", "baseline_days", "decision"]


def retrain_request(result: DataFrame, triggered_at, triggered_by: str = "drift_detection") -> DataFrame:
    """A request row (for an append-only requests table) per detected group."""
    key_cols = [c for c in result.columns if c not in _D1_COLS]
    return (result.where(F.col("drift_score").isNotNull() & F.col("drift_detected"))
            .select(*key_cols, F.lit(triggered_by).alias("triggered_by"),
                    F.col("drift_score"),
                    F.lit(str(triggered_at)).alias("triggered_at")))


# ── feature z-score drift (D2, A6, A7, J3) ───────────────────────────────────

def _unpivot(df: DataFrame, ids: list[str], cols: list[str], name="feature", value="value") -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(ids, cols, name, value)


def feature_moments(df: DataFrame, features: list[str], by=()) -> DataFrame:
    """Per (group, feature): n, mean, sample std — one shuffle for all columns
    via ``unpivot`` + ``groupBy``."""
    by = list(by)
    long = _unpivot(df, by, features)
    return long.groupBy(*by, "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"))


def recent_stats(log: DataFrame, by=(), ts_col="ts") -> DataFrame:
    """Count, flag rate, average score, average price×quantity and
    average hour of the recent log — one aggregation."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg(F.col("is_fraud").cast("double")).alias("fraud_rate"),
        F.avg("fraud_score").alias("avg_score"),
        F.avg(F.col("price") * F.col("quantity")).alias("transaction_amt_mean"),
        F.avg(F.hour(ts_col).cast("double")).alias("hour_of_day_mean"),
    )


def baseline_stats(train: DataFrame, features: list[str], label: str = "isFraud", by=()) -> DataFrame:
    """Label rate and rows (one row per group) — the per-feature moments
    come from :func:`feature_moments`."""
    return train.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.avg(F.col(label).cast("double")).alias("fraud_rate"))


def zscore_drift(recent: DataFrame, baseline: DataFrame, features: list[str],
                 recent_rate: str = "is_fraud", baseline_rate: str = "isFraud",
                 by=(), z_threshold: float = Z_THRESHOLD,
                 rate_threshold: float = RATE_CHANGE_THRESHOLD,
                 default_rate: float = DEFAULT_BASELINE_RATE) -> DataFrame:
    """Label-rate change and per-feature z = |Δmean| / baseline std.

    Features are compared by name (J3), skipping those missing on a side or
    with std 0.
    ``recent`` and ``baseline`` must already hold the monitored features
    under the same names, unscaled (Q8/Q9)."""
    by = list(by)
    # One scan and one map-side aggregation per side: the moments of every
    # feature and the flag rate come out as one row per group.
    def side(df: DataFrame, prefix: str, rate: str) -> DataFrame:
        moments = [F.struct(F.avg(F.col(f).cast("double")).alias("mean"),
                            F.stddev_samp(F.col(f).cast("double")).alias("std")).alias(f"{prefix}_{f}") for f in features]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias(f"n_{prefix}"),
                                   F.avg(F.col(rate).cast("double")).alias(f"{prefix}_rate"), *moments)

    sides = side(recent, "recent", recent_rate), side(baseline, "baseline", baseline_rate)
    if by:
        wide = sides[0].join(sides[1], by, "left")
    else:                                              # two one-row aggregates
        wide = sides[0].withColumn("_one", F.lit(1)).join(sides[1].withColumn("_one", F.lit(1)), "_one").drop("_one")
    entries = []
    for f in sorted(features):
        mean, base, std = F.col(f"recent_{f}.mean"), F.col(f"baseline_{f}.mean"), F.col(f"baseline_{f}.std")
        usable = mean.isNotNull() & base.isNotNull() & std.isNotNull() & (std != 0)
        z = round_half_even_exact(F.abs(mean - base) / F.nullif(std, F.lit(0.0)), 4)
        entries.append(F.when(usable, F.struct(F.lit(f).alias("feature"), z.alias("z"))))
    told = F.filter(F.array(*entries), lambda e: e.isNotNull())
    rep = wide.withColumn("_z", told).withColumns({
        "feature_z": F.map_from_entries("_z"),
        "shifted": F.transform(F.filter("_z", lambda e: e["z"] > z_threshold), lambda e: e["feature"])})
    change = F.abs(F.coalesce("recent_rate", F.lit(0.0))
                   - F.coalesce("baseline_rate", F.lit(default_rate)))
    rate_reason = F.when(change > rate_threshold, F.format_string(
        "Fraud rate changed by %.2f%% (from %.2f%% to %.2f%%)",
        change * 100, F.coalesce("baseline_rate", F.lit(default_rate)) * 100,
        F.coalesce("recent_rate", F.lit(0.0)) * 100))
    feat_reasons = F.transform(F.coalesce("shifted", F.array().cast("array<string>")),
                               lambda f: F.format_string(
                                   "%s mean shifted by %.1f standard deviations", f,
                                   F.element_at("feature_z", f)))
    reasons = F.concat(F.filter(F.array(rate_reason), lambda r: r.isNotNull()), feat_reasons)
    return rep.select(
        *by, "n_recent",
        F.coalesce("feature_z", F.create_map().cast("map<string,double>")).alias("feature_z"),
        change.alias("fraud_rate_change"),
        reasons.alias("reason"),
        (F.size(reasons) > 0).alias("drift_detected"))


# ── PSI (D3, D4) ─────────────────────────────────────────────────────────────

def psi(expected: DataFrame, actual: DataFrame, value_col: str, bins: int = PSI_BINS,
        by=(), epsilon: float = PSI_EPSILON, few_groups: bool = False) -> DataFrame:
    """D3: population stability index between two samples of ``value_col``.

    Pass 1: min/max over both sides per group (one row per group).
    Pass 2: bin counts per (group, side, bin) with numpy's edge semantics,
    zero-filled against the ``bins`` bin ids. ε-smoothed proportions
    ``(c+ε)/(n+ε·bins)``; PSI = Σ (a−e)·ln(a/e)."""
    by = list(by)
    v = F.col(value_col).cast("double")
    both = (expected.select(*by, v.alias("v"), F.lit("e").alias("side"))
            .unionByName(actual.select(*by, v.alias("v"), F.lit("a").alias("side")))
            .where(F.col("v").isNotNull() & ~F.isnan("v")))
    ranges = both.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # Grouped ranges (one row per group) join on the group key and AQE picks
    # the strategy; with ``few_groups`` (groups bounded by the schema, such as
    # feature names) they are broadcast, so raw rows are not moved. The global
    # range is two numbers, attached as literals.
    if by:
        binned = both.join(F.broadcast(ranges) if few_groups else ranges, by, "inner")
    else:
        rg = ranges.first()
        binned = both.select("*", F.lit(rg["lo"]).cast("double").alias("lo"),
                             F.lit(rg["hi"]).cast("double").alias("hi"))
    counts = (binned.groupBy(*by, equal_width_bin(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin"))
              .agg(F.count(F.when(F.col("side") == "e", 1)).alias("e_c"),
                   F.count(F.when(F.col("side") == "a", 1)).alias("a_c")))
    totals = counts.groupBy(*by).agg(F.sum("e_c").alias("e_n"), F.sum("a_c").alias("a_n"))
    grid = totals.select(*by, "e_n", "a_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, [*by, "bin"], "left").fillna(0, ["e_c", "a_c"])
    return _psi_of_counts(full, by, bins, epsilon)


def _psi_of_counts(full: DataFrame, by: list[str], bins: int, epsilon: float) -> DataFrame:
    """PSI from the zero-filled counts of both sides (e_c, a_c, e_n, a_n)."""
    e_p = (F.col("e_c") + epsilon) / (F.col("e_n") + epsilon * bins)
    a_p = (F.col("a_c") + epsilon) / (F.col("a_n") + epsilon * bins)
    term = (a_p - e_p) * F.log(a_p / e_p)
    out = full.groupBy(*by).agg(F.sum(term).alias("psi"),
                                F.first("e_n").alias("expected_n"), F.first("a_n").alias("actual_n"))
    empty = (F.col("expected_n") == 0) | (F.col("actual_n") == 0)
    out = out.withColumn("psi", F.when(empty, F.lit(None).cast("double")).otherwise(F.col("psi")))
    return out.withColumn("psi_band", psi_band("psi"))


def psi_from_baseline(histogram: DataFrame, live: DataFrame, features: list[str],
                      bins: int = PSI_BINS, epsilon: float = PSI_EPSILON) -> DataFrame:
    """D3 against a stored baseline (K10): the live values are binned onto the
    stored edges, so the training rows are not read. End bins are open: a value
    below the baseline's range counts in the first bin, one above it in the
    last. NULL and NaN are left out, as in :func:`psi`; a feature that the
    baseline does not hold gives no row. The stored histogram has at most
    ``bins`` rows per feature and is broadcast, live rows stay where they are."""
    edges = histogram.groupBy("feature").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"),
                                             F.sum("n").alias("e_n"))
    long = (live.select(*[F.col(c).cast("double").alias(c) for c in features])
            .unpivot([], features, "feature", "v").where(F.col("v").isNotNull() & ~F.isnan("v")))
    inside = F.least(F.greatest(F.col("v"), F.col("lo")), F.col("hi"))
    # All values equal in training: that value stands in the last bin, anything
    # below it in the first.
    at = F.when((F.col("lo") == F.col("hi")) & (F.col("v") < F.col("lo")), F.lit(0)).otherwise(
        equal_width_bin(inside, F.col("lo"), F.col("hi"), bins))
    seen = (long.join(F.broadcast(edges.select("feature", "lo", "hi")), "feature")
            .groupBy("feature", at.alias("bin")).agg(F.count(F.lit(1)).alias("a_c")))
    totals = edges.join(seen.groupBy("feature").agg(F.sum("a_c").alias("a_n")), "feature", "left").select(
        "feature", "e_n", F.coalesce("a_n", F.lit(0)).alias("a_n"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = (totals.where(F.col("feature").isin(features))
            .join(histogram.select("feature", "bin", F.col("n").alias("e_c")), ["feature", "bin"], "left")
            .join(seen, ["feature", "bin"], "left").fillna(0, ["e_c", "a_c"]))
    return _psi_of_counts(full, ["feature"], bins, epsilon)


def zscore_from_baseline(moments: DataFrame, live: DataFrame, features: list[str],
                         z_threshold: float = Z_THRESHOLD) -> DataFrame:
    """D2's per-feature z against stored moments (K10): one aggregation of the
    live rows, one row per feature on either side. Features missing on a side
    or with baseline std 0 are skipped, as in :func:`zscore_drift`."""
    now = feature_moments(live, features).select("feature", F.col("mean").alias("live_mean"))
    told = moments.join(now, "feature").where(
        F.col("live_mean").isNotNull() & F.col("mean").isNotNull() & F.col("std").isNotNull() & (F.col("std") != 0))
    z = round_half_even_exact(F.abs(F.col("live_mean") - F.col("mean")) / F.col("std"), 4)
    return told.select("feature", z.alias("z"), (z > z_threshold).alias("shifted"))


# ── count-window drift (D5, W1, W2) ──────────────────────────────────────────

def count_window_drift(log: DataFrame, n: int = COUNT_WINDOW, by=(), score_col="fraud_score",
                       order_cols=("ts", "id"), ts_col="ts", center: float = 0.5,
                       digits: int | None = 6) -> DataFrame:
    """Tumbling windows of ``n`` successful scores in arrival order;
    z = |mean(window) − mean(all so far)| / pop-std(all so far), where "so
    far" includes the window; pop-std 0 → 1e-6; incomplete windows emit
    nothing; values rounded to 6 digits.

    Arrival order is numbered with the distributed :func:`prefix_sums`
    scheme (W1), which in the same pass carries the running Σ(x−c) and
    Σ(x−c)² over every score so far (W2; shifted by ``center`` to avoid
    cancellation). A window's "all so far" moments are those of its last row,
    so the per-window table needs only one grouped aggregation — one range
    pass over the log in total."""
    by = list(by)
    keep = [*by, *order_cols] + ([ts_col] if ts_col not in order_cols else [])
    ok = log.where(F.col(score_col) >= 0).select(*keep, F.col(score_col).alias("_s"))
    x = F.col("_s") - F.lit(center)
    seq = prefix_sums(ok, list(order_cols),
                      {"_seq": F.lit(1).cast("bigint"), "_run_x": x, "_run_xx": x * x}, by)
    last = F.max_by(F.struct("_seq", "_run_x", "_run_xx"), F.col("_seq"))
    per_window = (seq.withColumn("window_no", F.floor((F.col("_seq") - 1) / n))
                  .groupBy(*by, "window_no")
                  .agg(F.count(F.lit(1)).alias("cnt"), F.avg("_s").alias("w_mean"),
                       F.stddev_pop("_s").alias("w_std"), F.max(ts_col).alias("ts_end"),
                       last.alias("_last"))
                  .where(F.col("cnt") == n))
    run = per_window.select("*", F.col("_last._seq").cast("double").alias("N"),
                            F.col("_last._run_x").alias("S"), F.col("_last._run_xx").alias("SS"))
    g_mean_c = F.col("S") / F.col("N")
    g_var = F.greatest(F.col("SS") / F.col("N") - g_mean_c * g_mean_c, F.lit(0.0))
    g_std = F.sqrt(g_var)
    g_std = F.when(g_std == 0, F.lit(STD_FLOOR)).otherwise(g_std)
    z = F.abs((F.col("w_mean") - F.lit(center)) - g_mean_c) / g_std
    rd = (lambda c: round_half_even_exact(c, digits)) if digits is not None else (lambda c: c)
    return run.where(F.col("N") >= 2).select(
        *by, F.col("window_no").cast("bigint").alias("window_no"),
        F.col("ts_end").alias("ts"),
        rd(z).alias("drift_score"),
        rd(F.col("w_mean")).alias("mean_score"),
        rd(F.col("w_std")).alias("std_score"),
        F.col("cnt").cast("int").alias("window_size"))
