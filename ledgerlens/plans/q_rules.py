"""Registered queries of the rule-scoring family (sources, filters, rules)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..sources import messages as M
from ..sources.tables import read_table, trades
from . import batch_rules
from .registry import ORACLES, register

AS_OF = "2001-07-31 00:00:00"   # fixed "now" of the load keys (the data ends 2001-08-01)


def _flat_scored(df):
    return df.select(
        F.col("transaction.hash").alias("tx_hash"),
        F.col("block.timestamp.unixtime").alias("block_unixtime"),
        F.col("buyCurrency.address").alias("buy_address"),
        F.col("evaluation"), F.col("transactions_in_window"),
        F.col("is_rapid_transaction"), F.col("is_flash_trade"),
        F.col("is_same_token"), F.col("is_fraud"))


def _flat_scored_from_trades(t):
    """Rule scoring of flat trades (trader = transaction hash)."""
    s = R.rule_flags(t, buy="buy_amount", sell="sell_amount", buy_symbol="buy_currency", sell_symbol="sell_currency")
    s = R.evaluate_trade(s, amount="buy_amount")
    s = R.rapid_transactions(s, None, trader_col="tx_hash", time_col="block_unixtime", hash_col="tx_hash")
    return R.fraud_flag(s).select("tx_hash", "block_unixtime", "is_fraud")


def _messages(spark, sf):
    return M.encode_messages(trades(spark, sf))


# ---------------------------------------------------------------- messages
@register("encode_messages", """
SELECT tx_hash, count(*) AS n_trades, round(sum(buy_amount), 4) AS buy_total
FROM trades GROUP BY tx_hash""")
def q_encode_messages(spark, sf):
    parsed = M.parse_messages(_messages(spark, sf))
    return (parsed.groupBy(F.col("transaction.hash").alias("tx_hash"))
            .agg(F.count(F.lit(1)).alias("n_trades"), F.round(F.sum("buyAmount"), 4).alias("buy_total")))


@register("parse_messages", """
SELECT protocol, block_unixtime, block_height, tx_hash, buy_currency, buy_address,
       round(buy_amount, 4) AS buy_amount, sell_currency, sell_address, round(sell_amount, 4) AS sell_amount,
       strftime(make_timestamp(block_unixtime * 1000000), '%Y-%m-%d %H:%M:%S') AS block_time, tx_hash AS trader_address
FROM trades""")
def q_parse_messages(spark, sf):
    p = M.parse_messages(_messages(spark, sf))
    return p.select(
        "protocol", F.col("block.timestamp.unixtime").alias("block_unixtime"),
        F.col("block.height").alias("block_height"), F.col("transaction.hash").alias("tx_hash"),
        F.col("buyCurrency.symbol").alias("buy_currency"), F.col("buyCurrency.address").alias("buy_address"),
        F.round("buyAmount", 4).alias("buy_amount"), F.col("sellCurrency.symbol").alias("sell_currency"),
        F.col("sellCurrency.address").alias("sell_address"), F.round("sellAmount", 4).alias("sell_amount"),
        F.col("block.timestamp.time").alias("block_time"), "trader_address")


def _feed(spark, sf):
    """A landing feed derived from the tables: every encoded message, a
    truncated (broken) copy of each, an error payload per "error" event and a
    foreign JSON object (the event's props) per other event."""
    msgs = _messages(spark, sf).select("value")
    broken = msgs.select(F.substring("value", 1, F.length("value") / 2).cast("string").alias("value"))
    ev = read_table(spark, sf, "events").select("event_type", "props")
    errors = ev.where(F.col("event_type") == "error").select(
        F.to_json(F.struct(F.array(F.struct(F.col("props").alias("message"))).alias("errors"))).alias("value"))
    foreign = ev.where(F.col("event_type") != "error").select(F.col("props").alias("value"))
    return msgs.unionByName(broken).unionByName(errors).unionByName(foreign)


@register("malformed_messages", """
SELECT 'undecodable' AS cause, count(DISTINCT tx_hash) AS n FROM trades
UNION ALL SELECT 'errors' AS cause, count(*) AS n FROM events WHERE event_type = 'error'
UNION ALL SELECT 'no_data' AS cause, count(*) AS n FROM events WHERE event_type <> 'error'""")
def q_malformed_messages(spark, sf):
    return M.malformed_messages(_feed(spark, sf)).groupBy("cause").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- loads
_LOAD_COLS = ["tx_hash", "block_unixtime", "buy_address", "sell_address", "analyzed"]


def load_trades(df, analyzed=None, as_of=AS_OF, minutes: int = 90, time_col: str = "detection_time"):
    """The three load modes of the graph job, with ``as_of`` as "now":
    analyzed=False: not analyzed and older than ``minutes``;
    analyzed=True: analyzed and newer than ``minutes``; None: all newer.
    Plain comparisons against a literal, so they push down to the scan."""
    cut = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    t = F.col(time_col)
    if analyzed is None:
        return df.where(t > cut)
    if analyzed:
        return df.where(F.col("analyzed") & (t > cut))
    return df.where(~F.col("analyzed") & (t < cut))


_CUT = f"TIMESTAMP '{AS_OF}' - INTERVAL 90 MINUTE"


@register("load_unanalyzed", f"SELECT {', '.join(_LOAD_COLS)} FROM trades WHERE NOT analyzed AND detection_time < {_CUT}")
def q_load_unanalyzed(spark, sf):
    return load_trades(trades(spark, sf), analyzed=False).select(*_LOAD_COLS)


@register("load_analyzed_recent", f"SELECT {', '.join(_LOAD_COLS)} FROM trades WHERE analyzed AND detection_time > {_CUT}")
def q_load_analyzed_recent(spark, sf):
    return load_trades(trades(spark, sf), analyzed=True).select(*_LOAD_COLS)


@register("load_recent", f"SELECT {', '.join(_LOAD_COLS)} FROM trades WHERE detection_time > {_CUT}")
def q_load_recent(spark, sf):
    return load_trades(trades(spark, sf), analyzed=None).select(*_LOAD_COLS)


def recent_trades(df, protocol: str, since_unixtime: int, limit: int,
                  time_col: str = "block_unixtime", order=("block_unixtime", "tx_hash", "buy_address")):
    """Source-side selection of the pollers: one protocol, since a time, at
    most ``limit`` rows, newest first (a top-k: TakeOrderedAndProject)."""
    sel = df.where((F.col("protocol") == protocol) & (F.col(time_col) >= F.lit(since_unixtime)))
    return sel.orderBy(*[F.col(c).desc() for c in order]).limit(limit)


@register("recent_trades", """
SELECT tx_hash, block_unixtime, buy_address, round(buy_amount, 4) AS buy_amount FROM trades
WHERE protocol = '1-URGENT' AND block_unixtime >= 978307200
ORDER BY block_unixtime DESC, tx_hash DESC, buy_address DESC LIMIT 10""")
def q_recent_trades(spark, sf):
    r = recent_trades(trades(spark, sf), "1-URGENT", 978307200, 10)   # since 2001-01-01
    return r.select("tx_hash", "block_unixtime", "buy_address", F.round("buy_amount", 4).alias("buy_amount"))


# ---------------------------------------------------------------- filters
# Messages of some transactions lack a struct: by the order key, the currency, the
# block, the block's time or the transaction itself.
_LOST = {11: (r'"buyCurrency":\{[^}]*\}', '"buyCurrency":null'), 13: (r'"block":\{"timestamp":\{[^}]*\},"height":[0-9]+\}', '"block":null'),
         17: (r'"timestamp":\{[^}]*\}', '"timestamp":null'), 19: (r'"transaction":\{[^}]*\}', '"transaction":null')}


def _damaged(spark, sf):
    m = _messages(spark, sf).withColumn("n", F.substring("tx_hash", 3, 20).cast("long"))
    for k, (pattern, null) in _LOST.items():
        m = m.withColumn("value", F.when(F.col("n") % k == 0, F.regexp_replace("value", pattern, null)).otherwise(F.col("value")))
    return M.parse_messages(m.select("value"))


@register("required_filter", """
SELECT tx_hash, block_unixtime, buy_address FROM trades
WHERE block_height % 11 <> 0 AND block_height % 13 <> 0 AND block_height % 17 <> 0 AND block_height % 19 <> 0""")
def q_required_filter(spark, sf):
    """Trades with all required structs, over messages of which some lack one."""
    p = R.required_filter(_damaged(spark, sf))
    return p.select(F.col("transaction.hash").alias("tx_hash"),
                    F.col("block.timestamp.unixtime").alias("block_unixtime"),
                    F.col("buyCurrency.address").alias("buy_address"))


@register("null_audit", """
SELECT count(*) FILTER (block_height % 13 = 0) AS null_block,
       count(*) FILTER (block_height % 13 = 0 OR block_height % 17 = 0) AS null_block_timestamp,
       count(*) FILTER (block_height % 19 = 0) AS null_transaction,
       count(*) FILTER (block_height % 11 = 0) AS null_buyCurrency, count(*) AS rows FROM trades""")
def q_null_audit(spark, sf):
    return R.null_audit(_damaged(spark, sf))


# ---------------------------------------------------------------- rules
@register("rule_flags", """
SELECT tx_hash, block_unixtime, buy_address, sell_address,
       coalesce(buy_amount > 1000000 AND NOT isnan(buy_amount), false)
         OR coalesce(sell_amount > 1000000 AND NOT isnan(sell_amount), false) AS is_flash_trade,
       coalesce(buy_currency = sell_currency, false) AS is_same_token
FROM trades""")
def q_rule_flags(spark, sf):
    t = R.rule_flags(trades(spark, sf), buy="buy_amount", sell="sell_amount",
                     buy_symbol="buy_currency", sell_symbol="sell_currency")
    return t.select("tx_hash", "block_unixtime", "buy_address", "sell_address", "is_flash_trade", "is_same_token")


@register("evaluate_trade", """
SELECT tx_hash, block_unixtime, buy_address,
       CASE WHEN buy_amount IS NULL OR buy_amount < 0.01 THEN 'Invalid' ELSE 'Valid' END AS evaluation
FROM trades""")
def q_evaluate_trade(spark, sf):
    return R.evaluate_trade(trades(spark, sf), amount="buy_amount").select(
        "tx_hash", "block_unixtime", "buy_address", "evaluation")


_RAPID_SQL = """
SELECT tx_hash, block_unixtime, buy_address, n AS transactions_in_window, n > 3 AS is_rapid_transaction
FROM (SELECT *, count(tx_hash) OVER (PARTITION BY {trader} ORDER BY block_unixtime
             RANGE BETWEEN 180 PRECEDING AND CURRENT ROW) AS n
      FROM ({rows}) u) w
WHERE {keep}"""


@register("rapid_batch_only", _RAPID_SQL.format(trader="tx_hash", rows="SELECT * FROM trades", keep="true"))
def q_rapid_batch_only(spark, sf):
    t = R.rapid_transactions(trades(spark, sf), None, trader_col="tx_hash", time_col="block_unixtime",
                             hash_col="tx_hash")
    return t.select("tx_hash", "block_unixtime", "buy_address", "transactions_in_window", "is_rapid_transaction")


@register("rapid_transactions", _RAPID_SQL.format(
    trader="sell_address",
    rows="""SELECT *, true AS cur FROM trades WHERE NOT analyzed
            UNION ALL
            SELECT *, false AS cur FROM trades WHERE analyzed AND block_unixtime BETWEEN
              (SELECT min(block_unixtime) - 180 FROM trades WHERE NOT analyzed)
              AND (SELECT max(block_unixtime) FROM trades WHERE NOT analyzed)""",
    keep="cur"))
def q_rapid_transactions(spark, sf):
    """Batch = trades not yet analyzed; history = analyzed trades; trader =
    the selling address (the trader column is a parameter)."""
    t = trades(spark, sf)
    batch, hist = t.where(~F.col("analyzed")), t.where(F.col("analyzed"))
    lo, hi = R.time_bounds(batch, "block_unixtime")
    hist = R.history_scan(hist, lo, hi, time_col="block_unixtime")
    r = R.rapid_transactions(batch, hist, trader_col="sell_address", time_col="block_unixtime",
                             hash_col="tx_hash")
    return r.select("tx_hash", "block_unixtime", "buy_address", "transactions_in_window", "is_rapid_transaction")


@register("rapid_rerun", ORACLES["rapid_transactions"], trades_cte=False)
def q_rapid_rerun(spark, sf):
    """The same batch run again, with its own rows already in the history: they
    are left out, so nothing counts twice."""
    t = trades(spark, sf)
    batch, hist = t.where(~F.col("analyzed")), t
    lo, hi = R.time_bounds(batch, "block_unixtime")
    hist = R.exclude_reprocessed(R.history_scan(hist, lo, hi, time_col="block_unixtime"), batch,
                                 time_col="block_unixtime", hash_col="tx_hash")
    r = R.rapid_transactions(batch, hist, trader_col="sell_address", time_col="block_unixtime", hash_col="tx_hash")
    return r.select("tx_hash", "block_unixtime", "buy_address", "transactions_in_window", "is_rapid_transaction")


@register("history_scan", """
SELECT tx_hash, block_unixtime, buy_address FROM trades WHERE analyzed AND block_unixtime BETWEEN
  (SELECT min(block_unixtime) - 180 FROM trades WHERE NOT analyzed)
  AND (SELECT max(block_unixtime) FROM trades WHERE NOT analyzed)""")
def q_history_scan(spark, sf):
    """History (analyzed trades) that can fall in a rule frame of the batch
    (trades not yet analyzed)."""
    t = trades(spark, sf)
    batch = t.where(~F.col("analyzed"))
    lo, hi = R.time_bounds(batch, "block_unixtime")
    return R.history_scan(t.where(F.col("analyzed")), lo, hi, time_col="block_unixtime").select(
        "tx_hash", "block_unixtime", "buy_address")


_SCORE_SQL = """
WITH s AS (
  SELECT tx_hash, block_unixtime, buy_address,
         CASE WHEN buy_amount IS NULL OR buy_amount < 0.01 THEN 'Invalid' ELSE 'Valid' END AS evaluation,
         count(tx_hash) OVER (PARTITION BY tx_hash ORDER BY block_unixtime
                              RANGE BETWEEN 180 PRECEDING AND CURRENT ROW) AS transactions_in_window,
         coalesce(buy_amount > 1000000 AND NOT isnan(buy_amount), false)
           OR coalesce(sell_amount > 1000000 AND NOT isnan(sell_amount), false) AS is_flash_trade,
         coalesce(buy_currency = sell_currency, false) AS is_same_token
  FROM trades)
SELECT *, transactions_in_window > 3 AS is_rapid_transaction,
       is_flash_trade OR is_same_token OR transactions_in_window > 3 OR evaluation = 'Invalid' AS is_fraud
FROM s"""


@register("batch_score", _SCORE_SQL)
def q_batch_score(spark, sf):
    return _flat_scored(batch_rules.batch_score(_messages(spark, sf)))
