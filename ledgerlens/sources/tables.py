"""Table readers and the flat-trade view the test data is mapped to.

The driver tables are a TPC-H-like star schema; trades are derived from
``lineitem JOIN orders JOIN part`` so every query's work grows with them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_conf


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (column pruning and filter pushdown
    happen when the caller selects / filters)."""
    ensure_conf(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat trades (FIXTURES F3 base columns) from the driver tables.

    protocol = order priority; one trade per lineitem; the seller is the
    customer, the buyer the part; the bought / sold token names are part
    names. Joins are equi-joins on keys: lineitem x orders is a large
    shuffle join, part is a dimension table that AQE broadcasts at runtime
    when its measured size allows it (no forced broadcast); beyond, a lineitem
    row is dealt out by part and by order, an order by customer and by order.
    """
    ensure_conf(spark)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    part = read_table(spark, sf_dir, "part")
    bp = part.select(F.col("p_partkey").alias("bp_partkey"), F.col("p_name").alias("buy_currency"))
    sp = part.select(F.col("p_partkey").alias("sp_partkey"), F.col("p_name").alias("sell_currency"))
    # names join the two tables before these meet, so the widest rows are never dealt out again
    sold = o.join(sp, F.col("o_custkey") == F.col("sp_partkey"), "left")
    j = li.join(bp, F.col("l_partkey") == F.col("bp_partkey")).join(sold, F.col("l_orderkey") == F.col("o_orderkey"))
    ts = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("l_linenumber") * 45
    return j.select(
        F.col("o_orderpriority").alias("protocol"),
        ts.alias("block_unixtime"),
        F.col("l_orderkey").alias("block_height"),
        F.concat(F.lit("0x"), F.col("l_orderkey").cast("string")).alias("tx_hash"),
        F.col("buy_currency"),
        F.concat(F.lit("a"), F.col("l_partkey").cast("string")).alias("buy_address"),
        (F.col("l_quantity") * F.col("l_extendedprice") * F.col("l_discount")).alias("buy_amount"),
        F.col("sell_currency"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("sell_address"),
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("sell_amount"),
        F.col("l_tax").alias("gas_value"),
        (F.lit(1.0) + F.col("l_tax")).alias("gas_price"),
        F.col("o_orderdate").cast("timestamp").alias("detection_time"),
        (F.col("o_orderstatus") == "F").alias("analyzed"),
    )


# DuckDB form of ``trades`` for the oracle SQL (a CTE prepended to queries).
TRADES_CTE_SQL = """trades AS (
  SELECT o_orderpriority AS protocol,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) + l_linenumber*45 AS block_unixtime,
         l_orderkey AS block_height, '0x' || CAST(l_orderkey AS VARCHAR) AS tx_hash,
         bp.p_name AS buy_currency, 'a' || CAST(l_partkey AS VARCHAR) AS buy_address,
         l_quantity*l_extendedprice*l_discount AS buy_amount,
         sp.p_name AS sell_currency, 'a' || CAST(o_custkey AS VARCHAR) AS sell_address,
         l_quantity*l_extendedprice AS sell_amount,
         l_tax AS gas_value, 1+l_tax AS gas_price,
         o_orderdate AS detection_time, o_orderstatus = 'F' AS analyzed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part bp ON l_partkey = bp.p_partkey
  LEFT JOIN part sp ON o_custkey = sp.p_partkey)"""
