"""SQL (DuckDB dialect) forms of the driver-table adapters in
``vigil.sources.tables``; the oracles in ``registry`` are written on top of
them as ``WITH`` prefixes. Same fixed values as the Spark adapters."""

PREDICTIONS = """
predictions AS (
  SELECT event_id AS id,
         ts,
         'U' || CAST(user_id AS VARCHAR) AS symbol,
         value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS quantity,
         epoch_us(ts) // 1000 AS trade_time,
         event_type IN ('view', 'click') AS is_buyer_maker,
         CASE WHEN event_type = 'error' THEN CAST(-1.0 AS DOUBLE)
              ELSE round(least(value / 340.0, 1.0), 6) END AS fraud_score,
         CASE WHEN event_type <> 'error' AND round(least(value / 340.0, 1.0), 6) >= 0.5
              THEN 1 ELSE 0 END AS is_fraud,
         CAST(0.5 AS DOUBLE) AS threshold
  FROM events)"""

DASHBOARD = PREDICTIONS + """,
dash AS (SELECT * FROM predictions WHERE fraud_score >= 0)"""

LABELLED = """
labelled_scores AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_linestatus AS segment,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         least(l_extendedprice / 100000.0, 1.0) AS score
  FROM lineitem)"""

TRANSACTIONS = """
transactions AS (
  SELECT o.o_orderkey AS TransactionID,
         date_diff('second', TIMESTAMP '1992-01-01 00:00:00', o.o_orderdate) AS TransactionDT,
         o.o_totalprice AS TransactionAmt,
         o.o_orderpriority AS ProductCD,
         c.c_mktsegment AS card4,
         CAST(c.c_nationkey AS DOUBLE) AS card1,
         c.c_acctbal AS acct_balance,
         CAST(o.o_orderstatus = 'P' AS INTEGER) AS isFraud
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

IDENTITY = """
merged AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def with_(*views: str) -> str:
    return "WITH " + ",".join(v.strip().rstrip(",") for v in views) + "\n"
