"""Driver tables and the deterministic adapters that turn them into the
shapes the risk operators consume (SURVEY §7.2).

All adapters are narrow projections (plus one key join for ``transactions``),
so Catalyst prunes the parquet scan to the columns each query touches and
pushes its predicates into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.scalars import flag

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the adapters (shared with the SQL oracles in plans/registry.py).
SCORE_DIVISOR = 340.0          # fraud_score = round(least(value / 340, 1), 6)
FAILED_EVENT_TYPE = "error"    # an errored call is logged with score -1.0
BUYER_MAKER_TYPES = ("view", "click")
FLAG_THRESHOLD = 0.5
TRANSACTION_EPOCH = "1992-01-01 00:00:00"
FRAUD_STATUS = "P"             # transactions label: o_orderstatus = 'P'
RETURN_LABEL = "R"             # labelled_scores label: l_returnflag = 'R'
PRICE_SCALE = 100000.0         # labelled_scores score = least(price / 1e5, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log (FIXTURES §6/§7) derived from ``events``.

    Errored events stand for failed scoring calls: score −1.0, never flagged.
    """
    ev = read_table(spark, sf_dir, "events")
    # ``ts`` keeps the table's own type (timestamp_ntz, read as UTC) so time
    # predicates compare against literals of that type and reach the scan.
    ts = F.col("ts")
    score = (F.when(F.col("event_type") == FAILED_EVENT_TYPE, F.lit(-1.0))
             .otherwise(F.round(F.least(F.col("value") / SCORE_DIVISOR, F.lit(1.0)), 6)))
    return ev.select(
        F.col("event_id").alias("id"),
        ts.alias("ts"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("quantity"),
        F.unix_millis(ts.cast("timestamp")).alias("trade_time"),
        F.col("event_type").isin(*BUYER_MAKER_TYPES).alias("is_buyer_maker"),
        score.alias("fraud_score"),
        flag(score, FLAG_THRESHOLD).alias("is_fraud"),
        F.lit(FLAG_THRESHOLD).alias("threshold"),
    )


def dashboard_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the monitoring store holds: successful scores only."""
    return predictions(spark, sf_dir).where(F.col("fraud_score") >= 0)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trade events (FIXTURES §5 renamed) derived from ``events``.
    ``price``/``quantity`` stay strings, as on the wire."""
    ev = read_table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return ev.select(
        F.lit("trade").alias("event_type"),
        ms.alias("event_ms"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").cast("string").alias("price"),
        (F.get_json_object("props", "$.k").cast("double") / 100).cast("string").alias("quantity"),
        ms.alias("trade_ms"),
        F.col("event_type").isin(*BUYER_MAKER_TYPES).alias("is_buyer_maker"),
        F.lit("binance").alias("source"),
    )


def trade_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades rendered as the one-letter JSON messages of the wire format."""
    t = trades(spark, sf_dir)
    return t.select(F.to_json(F.struct(
        F.col("event_type").alias("e"), F.col("event_ms").alias("E"),
        F.col("symbol").alias("s"), F.col("trade_id").alias("t"),
        F.col("price").alias("p"), F.col("quantity").alias("q"),
        F.col("trade_ms").alias("T"), F.col("is_buyer_maker").alias("m"),
        F.col("source"))).alias("value"), F.col("trade_ms"))


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, segment, label, score) for evaluation, derived from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_linestatus").alias("segment"),
        (F.col("l_returnflag") == RETURN_LABEL).cast("int").alias("label"),
        F.least(F.col("l_extendedprice") / PRICE_SCALE, F.lit(1.0)).alias("score"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (FIXTURES §1/§2 shape) from ``orders`` ⟕ ``customer``.

    The customer side is a plain equi-join: Catalyst/AQE choose broadcast when
    the customer table is small and sort-merge when it is not.
    """
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    dt = (F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
          - F.unix_seconds(F.lit(TRANSACTION_EPOCH).cast("timestamp")))
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("TransactionID"),
        dt.alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        F.col("o_orderpriority").alias("ProductCD"),
        F.col("c_mktsegment").alias("card4"),
        F.col("c_nationkey").cast("double").alias("card1"),
        F.col("c_acctbal").alias("acct_balance"),
        (F.col("o_orderstatus") == FRAUD_STATUS).cast("int").alias("isFraud"),
    )


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left side of the identity join: every column of the documents; a query
    that needs no text prunes it from the scan."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels")
