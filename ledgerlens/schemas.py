"""Fixed schemas of the trade data model and of every result table, plus
``conform`` which projects a frame onto one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()

CURRENCY = T.StructType([_f("symbol", S), _f("address", S)])
BLOCK = T.StructType([
    _f("timestamp", T.StructType([_f("time", S), _f("unixtime", L)])),
    _f("height", L),
])
TRANSACTION = T.StructType([_f("hash", S)])

# One element of ``data.ethereum.dexTrades``. Amounts and gas are read as text
# and converted with try_cast afterwards: numeric text such as "1.5" must be
# accepted, and from_json with a double field would null it.
RAW_TRADE = T.StructType([
    _f("protocol", S),
    _f("block", BLOCK),
    _f("transaction", TRANSACTION),
    _f("buyCurrency", CURRENCY),
    _f("buyAmount", S),
    _f("sellCurrency", CURRENCY),
    _f("sellAmount", S),
    _f("trades", L),
    _f("gasValue", S),
    _f("gasPrice", S),
])

# The message envelope, one JSON object per line / per stream record.
ENVELOPE = T.StructType([
    _f("data", T.StructType([
        _f("ethereum", T.StructType([_f("dexTrades", T.ArrayType(RAW_TRADE))])),
    ])),
    _f("errors", T.ArrayType(T.StructType([_f("message", S)]))),
])

# Table 1: scored batch trades (nested form).
BATCH_SCORED = T.StructType([
    _f("protocol", S),
    _f("block", BLOCK, False),
    _f("transaction", TRANSACTION, False),
    _f("buyCurrency", CURRENCY, False),
    _f("buyAmount", D),
    _f("sellCurrency", CURRENCY),
    _f("sellAmount", D),
    _f("trades", L),
    _f("trader_address", S),
    _f("evaluation", S),
    _f("transactions_in_window", L),
    _f("is_rapid_transaction", B),
    _f("is_flash_trade", B),
    _f("is_same_token", B),
    _f("is_fraud", B, False),
])

# Table 2: flat scored trades (stream output, graph input).
FLAT_TRADE = T.StructType([
    _f("protocol", S), _f("block_timestamp", TS), _f("block_unixtime", L), _f("block_height", L),
    _f("tx_hash", S), _f("buy_currency", S), _f("buy_address", S), _f("buy_amount", D),
    _f("sell_currency", S), _f("sell_address", S), _f("sell_amount", D), _f("trade_ratio", D),
    _f("gas_value", D), _f("gas_price", D), _f("gas_cost_relative", D),
    _f("time_of_day_sin", D), _f("time_of_day_cos", D), _f("anomaly_score", D),
    _f("detection_time", TS), _f("reason", S), _f("analyzed", B),
])

GRAPH_VERTICES = T.StructType([
    _f("id", S, False), _f("total_buy_volume", D), _f("buy_transactions", L),
    _f("total_sell_volume", D), _f("sell_transactions", L), _f("symbol", S),
    _f("total_transactions", L), _f("total_volume", D),
    _f("analysis_timestamp", TS),      # run stamp, so readers can pick the latest run
])

GRAPH_EDGES = T.StructType([
    _f("src", S, False), _f("dst", S, False), _f("total_buy_value", D), _f("total_sell_value", D),
    _f("transaction_count", L), _f("avg_gas_price", D), _f("latest_timestamp", TS), _f("weight", D),
    _f("analysis_timestamp", TS),
])

IMPORTANT_ADDRESSES = T.StructType([
    _f("id", S), _f("symbol", S), _f("pagerank", D), _f("total_transactions", L),
    _f("total_volume", D), _f("analysis_timestamp", TS)])
NETWORK_COMMUNITIES = T.StructType([_f("component", S), _f("count", L), _f("analysis_timestamp", TS)])
IN_DEGREE_ADDRESSES = T.StructType([_f("id", S), _f("symbol", S), _f("inDegree", L), _f("analysis_timestamp", TS)])
OUT_DEGREE_ADDRESSES = T.StructType([_f("id", S), _f("symbol", S), _f("outDegree", L), _f("analysis_timestamp", TS)])
COMMUNITY_MEMBERS = T.StructType([
    _f("id", S), _f("component", S), _f("symbol", S), _f("total_transactions", L),
    _f("total_volume", D), _f("analysis_timestamp", TS)])
TOKEN_PAIRS = T.StructType([_f("buy_token", S), _f("sell_token", S), _f("count", L), _f("analysis_timestamp", TS)])
CLUSTER_ANOMALIES = T.StructType([
    _f("id", S), _f("prediction", L), _f("distance_to_centroid", D), _f("inDegree", L),
    _f("outDegree", L), _f("pagerank", D), _f("sent_volume", D), _f("received_volume", D),
    _f("transactions_sent", L), _f("transactions_received", L), _f("detection_time", TS)])
VOLUME_RATIO_ANOMALIES = T.StructType([
    _f("id", S), _f("volume_ratio", D), _f("sent_volume", D), _f("received_volume", D),
    _f("transactions_sent", L), _f("transactions_received", L), _f("detection_time", TS)])

RESULT_TABLES = {
    "important_addresses": IMPORTANT_ADDRESSES,
    "network_communities": NETWORK_COMMUNITIES,
    "in_degree_addresses": IN_DEGREE_ADDRESSES,
    "out_degree_addresses": OUT_DEGREE_ADDRESSES,
    "community_members": COMMUNITY_MEMBERS,
    "token_pairs": TOKEN_PAIRS,
    "graph_based_anomalous_addresses": CLUSTER_ANOMALIES,
    "volume_ratio_high_anomalous_addresses": VOLUME_RATIO_ANOMALIES,
    "volume_ratio_low_anomalous_addresses": VOLUME_RATIO_ANOMALIES,
    "graph_vertices": GRAPH_VERTICES,
    "graph_edges": GRAPH_EDGES,
    "trades_table": FLAT_TRADE,
    "batch_processed_data": BATCH_SCORED,
}


def _cast(c: Column, dtype: T.DataType) -> Column:
    # try_cast keeps a bad value as null instead of failing the whole job
    return c.try_cast(dtype) if isinstance(dtype, (T.NumericType, T.BooleanType)) else c.cast(dtype)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: same column order and types, columns
    the table lacks dropped, absent columns filled with ``defaults`` or null.

    A pure projection: no shuffle, fuses into the producing stage."""
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            cols.append((c if df.schema[f.name].dataType == f.dataType else _cast(c, f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)
