"""Column expressions: flags, bands, ratios, time and trade parsing.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen wherever they are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for identical results).
FAILED_SCORE = -1.0                 # score written when a call fails
NULL_FILL = -999.0                  # sentinel for missing feature values
BAND_HIGH, BAND_MODERATE = 0.8, 0.5  # score bands: >=0.8 high, >=0.5 moderate, else legit
PSI_STABLE, PSI_MINOR = 0.1, 0.2     # PSI bands: <0.1 stable, <=0.2 minor, >0.2 significant


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(score, threshold=0.5) -> Column:
    """``score >= t and score != -1`` as int."""
    s = _c(score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return ((s >= t) & (s != F.lit(FAILED_SCORE))).cast("int")


def score_band(score) -> Column:
    """P9."""
    s = _c(score)
    return (F.when(s >= BAND_HIGH, "high").when(s >= BAND_MODERATE, "moderate")
            .otherwise("legit"))


def severity(drift_score, threshold) -> Column:
    """P10: HIGH when drift exceeds twice the threshold."""
    d = _c(drift_score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(d > t * 2, "HIGH").otherwise("MEDIUM")


def psi_band(psi) -> Column:
    """D4."""
    p = _c(psi)
    return (F.when(p.isNull(), None).when(p < PSI_STABLE, "stable")
            .when(p <= PSI_MINOR, "minor").otherwise("significant"))


def safe_ratio(num, den) -> Column:
    """Ratio that is 0 (not an error, not NULL) when the denominator is 0
    or NULL. ANSI mode is on, so a plain ``/`` by zero raises."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


def time_features(dt_seconds) -> tuple[Column, Column]:
    """fractional hour-of-day and day-of-week offsets from a seconds delta."""
    dt = _c(dt_seconds).cast("double")
    return F.pmod(dt / 3600.0, F.lit(24.0)), F.pmod(dt / 86400.0, F.lit(7.0))


def log1p(x) -> Column:
    """F2 (NULL below −1, where numpy gives NaN)."""
    return F.log1p(_c(x))


_SPLIT = 134217729.0   # 2^27 + 1, Dekker's splitter for IEEE doubles


def _split(a):
    c = a * _SPLIT
    hi = c - (c - a)
    return hi, a - hi


def round_half_even_exact(x, digits: int = 6) -> Column:
    """Python's ``round(x, digits)``: the exact binary value of ``x`` rounded
    to ``digits`` decimals, half-even only on exact ties, then the nearest
    double. ``x·10^d`` is formed error-free (Dekker two-product: ``p + e``),
    so which side of the decimal tie ``x`` lies on is decided exactly — plain
    ``bround`` decides on the shortest decimal repr instead (1.0000005 →
    1.0, where Python gives 1.000001). Built-in arithmetic only."""
    x = _c(x).cast("double")
    m_ = float(10 ** digits)
    p = x * m_
    xh, xl = _split(x)
    bh = float(int(m_ * _SPLIT) - int((m_ * _SPLIT) - m_))   # exact split of 10^d (an integer)
    bl = m_ - bh
    e = ((xh * bh - p) + xh * bl + xl * bh) + xl * bl        # x·10^d = p + e exactly
    fl = F.floor(p).cast("double")
    fl = F.when((p == fl) & (e < 0), fl - 1).otherwise(fl)   # floor of the exact product
    d = (p - fl) - 0.5                                       # exact
    up = F.when(d > 0, True).when(d < 0, False) \
        .when(e > 0, True).when(e < 0, False) \
        .otherwise(F.pmod(fl, F.lit(2.0)) == 1.0)            # exact tie → even
    rounded = (fl + F.when(up, 1.0).otherwise(0.0)) / m_
    big = F.abs(x) >= F.lit(2.0 ** 52 / m_)                  # already at or past 10^-d resolution
    return F.when(x.isNull() | F.isnan(x) | big, x).otherwise(rounded)


def round6(x) -> Column:
    """6-digit round exactly as Python's ``round`` (see above)."""
    return round_half_even_exact(x, 6)


def weekday_monday0(ts) -> Column:
    """Monday = 0 … Sunday = 6 (``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(ts))


def trade_amount(price, quantity, log: bool = True) -> Column:
    """F8: price × quantity from wire strings; unparsable/missing → 0."""
    p = F.coalesce(_try_double(price), F.lit(0.0))
    q = F.coalesce(_try_double(quantity), F.lit(0.0))
    amt = p * q
    return F.log1p(amt) if log else amt


def _try_double(x) -> Column:
    c = _c(x)
    return c.try_cast("double")


def trade_timestamp(trade_ms, event_ms) -> Column:
    """coalesce(T, E, 0) epoch milliseconds → UTC timestamp."""
    ms = F.coalesce(_c(trade_ms).try_cast("bigint"), _c(event_ms).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.timestamp_millis(ms)


def parse_log_time(text) -> Column:
    """ISO-8601 text (naive or with offset/Z) → timestamp (UTC)."""
    return F.coalesce(F.try_to_timestamp(_c(text)),
                      F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
                      F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


TRADE_JSON_SCHEMA = "map<string,string>"


def parse_trade_json(value) -> Column:
    """JSON text → map<string,string>. Map keys are exact, so ``t``/``T``
    and ``e``/``E`` do not collide (a struct would be ambiguous under the
    default case-insensitive resolver). Bad JSON → NULL map."""
    return F.from_json(_c(value).cast("string"), TRADE_JSON_SCHEMA,
                       {"mode": "PERMISSIVE"})


def round_to(x, digits: int) -> Column:
    """Round half away from zero as ``round(x·10^d)/10^d`` (the float steps of
    most SQL engines' ``round`` on doubles)."""
    m = float(10 ** digits)
    return F.round(_c(x) * m, 0) / m
