"""Trade events → feature vectors (F8–F10, F13, P3), batch or streaming.

All of it is projection over built-in expressions, so the same plan runs in a
batch job and inside a streaming micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.scalars import (NULL_FILL, parse_trade_json, trade_amount,
                                     trade_timestamp, weekday_monday0)

# Wire names of the trade message and our column names (fixed by the format).
WIRE_FIELDS = {"e": "event_type", "E": "event_ms", "s": "symbol", "t": "trade_id",
               "p": "price", "q": "quantity", "T": "trade_ms", "m": "is_buyer_maker",
               "source": "source"}
DEFAULT_SYMBOL = "BTCUSDT"
SOURCE_TAG = "binance"


def parse_trades(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text → typed trade columns + ``_parsed`` (false for bad
    JSON: route those rows to a quarantine table). Other columns of ``raw``
    stay unless they bear the name of a parsed one."""
    j = parse_trade_json(value_col)
    staged = raw.select("*", j.alias("_j"))
    g = lambda k: F.col("_j").getItem(k)
    return staged.select(
        *[c for c in raw.columns if c not in (*WIRE_FIELDS.values(), "_parsed")],
        g("e").alias("event_type"),
        g("E").try_cast("bigint").alias("event_ms"),
        g("s").alias("symbol"),
        g("t").try_cast("bigint").alias("trade_id"),
        g("p").alias("price"),
        g("q").alias("quantity"),
        g("T").try_cast("bigint").alias("trade_ms"),
        g("m").try_cast("boolean").alias("is_buyer_maker"),
        g("source").alias("source"),
        (F.col("_j").isNotNull() & (F.size("_j") > 0)).alias("_parsed"))


def inputs_valid(price="price", quantity="quantity", parsed: str | None = "_parsed"):
    """A trade scores only when its JSON parsed and present numeric fields
    parse (a missing field counts as 0, as in the reference)."""
    ok = lambda c: F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()
    cond = ok(price) & ok(quantity)
    return cond if parsed is None else (F.col(parsed) & cond)


def map_trade(trades: DataFrame, feature_cols: list[str], log_cols=("TransactionAmt",),
              fill: float = NULL_FILL, model=None, scale: bool = False) -> DataFrame:
    """F10 (+F8, F9): every feature −999 except TransactionAmt (p·q, log1p if
    listed), hour_of_day / day_of_week (UTC calendar fields, Monday = 0) and
    isBuyerMaker when they are listed; trace columns ``_trade_id``,
    ``_symbol``, ``_price``, ``_quantity``, ``_timestamp``. ``scale=True``
    applies the fitted scaler of ``model`` (the documented intent)."""
    ts = trade_timestamp("trade_ms", "event_ms")
    known = {
        "TransactionAmt": trade_amount("price", "quantity", log="TransactionAmt" in set(log_cols)),
        "hour_of_day": F.hour(ts).cast("double"),
        "day_of_week": weekday_monday0(ts).cast("double"),
        "isBuyerMaker": F.coalesce(F.col("is_buyer_maker").cast("int"), F.lit(0)).cast("double"),
    }
    feats = []
    for c in feature_cols:
        x = known.get(c, F.lit(float(fill)))
        if scale and model is not None:
            sd = model.stds[c]
            x = F.lit(0.0) if sd == 0 else (x - F.lit(model.means[c])) / F.lit(sd)
        feats.append(x.alias(c))
    p = F.coalesce(F.col("price").try_cast("double"), F.lit(0.0))
    q = F.coalesce(F.col("quantity").try_cast("double"), F.lit(0.0))
    return trades.select(
        "*", *feats,
        F.coalesce(F.col("trade_id").cast("string"), F.lit("unknown")).alias("_trade_id"),
        F.coalesce(F.col("symbol"), F.lit("unknown")).alias("_symbol"),
        p.alias("_price"), q.alias("_quantity"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("_timestamp"))


def order_features(df: DataFrame, feature_cols: list[str], fill: float = NULL_FILL,
                   name: str = "feature_vector") -> DataFrame:
    """The vector in training order as array<double>, missing → −999."""
    return df.withColumn(name, F.array(*[
        F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) if c in df.columns
        else F.lit(float(fill)) for c in feature_cols]))


def publish_frame(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """K2: (messages, quarantine). Messages are the parsed JSON with
    ``source`` added, keyed by symbol (default BTCUSDT) so one symbol keeps
    one partition (M5); rows whose JSON does not parse go to quarantine."""
    text = F.col(value_col).cast("string")
    typed = F.from_json(text, WIRE_SCHEMA)
    m = parse_trade_json(value_col)
    staged = raw.select(text.alias("_raw"), typed.alias("_t"), m.getItem("s").alias("_s"),
                        (m.isNotNull() & (F.size(m) > 0)).alias("_ok"))
    good = staged.where(F.col("_ok"))
    out = good.select(
        F.coalesce(F.col("_s"), F.lit(DEFAULT_SYMBOL)).cast("binary").alias("key"),
        F.to_json(F.col("_t").withField("source", F.lit(SOURCE_TAG))).alias("value"))
    bad = staged.where(~F.col("_ok")).select(F.col("_raw").alias("value"))
    return out, bad


# Typed wire schema: both ``t``/``T`` and ``e``/``E`` are distinct fields.
WIRE_SCHEMA = "e string, E bigint, s string, t bigint, p string, q string, T bigint, m boolean"
