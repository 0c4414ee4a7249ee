"""Registered queries of the sinks: each writes to the shared scratch folder, reads
back and returns what a reader of the table sees."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import graph as G
from ..operators import rules as R
from ..session import path_exists, scratch_path, stored
from ..sources import messages as M
from ..sources import sinks as SK
from ..sources.tables import trades
from . import batch_rules, q_graph
from .registry import register

_PAIRS = """
SELECT buy_currency AS buy_token, sell_currency AS sell_token, count(*) AS count FROM trades GROUP BY 1, 2
ORDER BY count DESC, buy_token NULLS FIRST, sell_token NULLS FIRST LIMIT 100"""


@register("sink_append_latest", f"""
SELECT buy_token, sell_token, count, '2024-01-01 01:00:00' AS run, 200 AS stored, 100 AS last_written, false AS empty_written
FROM ({_PAIRS})""")
def q_sink_append_latest(spark, sf):
    """Two runs append to a created table; a reader takes the latest run. The
    rows of the last write come from the write; an empty frame is not written."""
    base = scratch_path(spark, "results")
    pairs = G.token_pairs(trades(spark, sf), 100)
    SK.ensure_table(spark, "token_pairs", base)
    for run in ("2024-01-01 00:00:00", "2024-01-01 01:00:00"):
        written = SK.save_results({"token_pairs": pairs, "network_communities": pairs.limit(0)}, base, run)
    stored = spark.read.parquet(f"{base}/token_pairs")
    empty = "network_communities" in written or path_exists(spark, f"{base}/network_communities")
    return SK.latest_snapshot(stored).select(
        "buy_token", "sell_token", "count", F.date_format("analysis_timestamp", "yyyy-MM-dd HH:mm:ss").alias("run"),
        F.lit(stored.count()).cast("int").alias("stored"), F.lit(written["token_pairs"]).cast("int").alias("last_written"),
        F.lit(empty).alias("empty_written"))


@register("sink_overwrite", f"SELECT buy_token, sell_token, count FROM ({_PAIRS})")
def q_sink_overwrite(spark, sf):
    """A second run in overwrite mode leaves its own rows alone."""
    base = scratch_path(spark, "results")
    t = trades(spark, sf)
    SK.save_results({"token_pairs": G.token_pairs(t, 7)}, base, "2024-01-01 00:00:00")
    SK.save_results({"token_pairs": G.token_pairs(t, 100)}, base, "2024-01-01 01:00:00", mode="overwrite")
    return spark.read.parquet(f"{base}/token_pairs").select("buy_token", "sell_token", "count")


@register("sink_edges_stored", """
SELECT sell_address AS src, buy_address AS dst, count(*) AS transaction_count,
       strftime(make_timestamp(max(block_unixtime) * 1000000), '%Y-%m-%d %H:%M:%S') AS latest
FROM trades WHERE sell_address IS NOT NULL AND buy_address IS NOT NULL GROUP BY 1, 2""")
def q_sink_edges_stored(spark, sf):
    """The edge table in its stored layout: epoch to timestamp, run stamp."""
    base = scratch_path(spark, "results")
    SK.ensure_table(spark, "graph_edges", base)
    SK.save_results({"graph_edges": G.build_edges(trades(spark, sf))}, base, "2024-01-01 00:00:00")
    return spark.read.parquet(f"{base}/graph_edges").where(F.col("analysis_timestamp").isNotNull()).select(
        "src", "dst", "transaction_count", F.date_format("latest_timestamp", "yyyy-MM-dd HH:mm:ss").alias("latest"))


@register("scored_history", """
WITH b AS (SELECT max(block_unixtime) - 30 * 86400 AS lo, max(block_unixtime) AS hi FROM trades)
SELECT tx_hash, block_unixtime, buy_amount, sell_amount FROM trades, b
WHERE block_unixtime BETWEEN lo - 180 AND hi""")
def q_scored_history(spark, sf):
    """The scored table, appended by block date, read back as the history of a
    batch of its last 30 days: the bounds are literals on the stored time and
    the partition column, so older folders are never listed."""
    t = trades(spark, sf)
    path = scratch_path(spark, "scored")
    batch_rules.append_scored(batch_rules.batch_score(M.encode_messages(t)), path)
    hi = t.agg(F.max("block_unixtime")).first()[0]
    kept = R.history_scan(spark.read.parquet(path), hi - 30 * 86400, hi)
    return kept.select(F.col("transaction.hash").alias("tx_hash"),
                       F.col("block.timestamp.unixtime").alias("block_unixtime"),
                       F.col("buyAmount").alias("buy_amount"), F.col("sellAmount").alias("sell_amount"))


_EDGE_NOTES = ", ".join(f"('{c}', '{n}')" for c, n in SK.COLUMN_COMMENTS["graph_edges"].items())


@register("sink_catalog_table", f"""
SELECT c.name, c.comment, 2 * e.n AS filled, e.n AS written FROM (VALUES {_EDGE_NOTES}) c(name, comment),
  (SELECT count(*) AS n FROM (SELECT DISTINCT sell_address, buy_address FROM trades
     WHERE sell_address IS NOT NULL AND buy_address IS NOT NULL)) e""")
def q_sink_catalog_table(spark, sf):
    """A table of the session's catalog: created once with comments, appended by
    two runs; per column its comment, as the catalog tells it, and its values."""
    table = f"graph_edges_{uuid.uuid4().hex}"
    where = scratch_path(spark, "catalog")
    edges = G.build_edges(trades(spark, sf))
    for run in ("2024-01-01 00:00:00", "2024-01-01 01:00:00"):
        SK.create_table(spark, table, "graph_edges", where)
        written = SK.append_table(edges, table, "graph_edges", run)
    notes = [(c.name, c.description) for c in spark.catalog.listColumns(table)]
    stored = spark.table(table)
    filled = stored.agg(*[F.count(n).alias(n) for n, _ in notes]).first()
    return spark.createDataFrame([(n, d, filled[n], written) for n, d in notes], "name string, comment string, filled long, written long")


@register("update_analyzed", """
WITH hit AS (SELECT DISTINCT tx_hash FROM trades WHERE NOT analyzed AND detection_time >= TIMESTAMP '1999-01-01' AND
               detection_time < TIMESTAMP '1999-03-01'),
t AS (SELECT strftime(detection_time, '%Y-%m') AS month, analyzed, NOT analyzed AND tx_hash IN (SELECT tx_hash FROM hit) AS updated FROM trades)
SELECT month, count(*) AS n, count(*) FILTER (analyzed OR updated) AS analyzed, NOT bool_or(updated) AS unchanged,
       (SELECT count(*) FROM t WHERE updated) AS rows_updated
FROM t GROUP BY month""")
def q_update_analyzed(spark, sf):
    """The flag update on a stored table partitioned by month, for the trades of
    two months: rows and flags per month afterwards, whether the month kept its
    files, and the rows updated."""
    path = scratch_path(spark, "trades")
    t = trades(spark, sf).withColumn("month", F.date_format("detection_time", "yyyy-MM"))
    t.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    files = lambda: spark.read.parquet(path).select("month", F.col("_metadata.file_name").alias("f")).distinct()
    before = files().groupBy("month").agg(F.sort_array(F.collect_set("f")).alias("was")).collect()
    stored = spark.read.parquet(path)
    done = stored.where(~F.col("analyzed") & (F.col("detection_time") >= F.lit("1999-01-01").cast("timestamp"))
                        & (F.col("detection_time") < F.lit("1999-03-01").cast("timestamp")))
    n = SK.update_analyzed(spark, path, done.select("tx_hash").checkpoint(), "month")
    # a row per folder
    was = spark.createDataFrame([(r["month"], r["was"]) for r in before], "month string, was array<string>")
    now = files().groupBy("month").agg(F.sort_array(F.collect_set("f")).alias("now"))
    return spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.count_if("analyzed").alias("analyzed")) \
        .join(now, "month").join(was, "month") \
        .select(F.col("month").cast("string").alias("month"), "n", "analyzed", (F.col("now") == F.col("was")).alias("unchanged"),
                F.lit(n).cast("long").alias("rows_updated"))


@register("sink_anomalies", q_graph._M_SQL + """,
vr AS (SELECT *, CASE WHEN received_volume > 0 THEN sent_volume / received_volume ELSE 0.0 END AS volume_ratio FROM m),
k AS (SELECT 'volume_ratio_high_anomalous_addresses' AS tbl, id, volume_ratio FROM vr
        WHERE volume_ratio > 10 AND sent_volume > 0 AND transactions_sent > 5
      UNION ALL SELECT 'volume_ratio_low_anomalous_addresses', id, volume_ratio FROM vr
        WHERE volume_ratio < 0.1 AND received_volume > 0 AND transactions_received > 5)
SELECT tbl, id, round(volume_ratio, 6) AS volume_ratio, '2024-01-01 00:00:00' AS run, count(*) OVER (PARTITION BY tbl) AS written FROM k""")
def q_sink_anomalies(spark, sf):
    """The anomaly tables as stored: stamped, with the rows of each write."""
    base = scratch_path(spark, "results")
    m = stored(A.graph_metrics(q_graph.graph_trades(spark, sf))[3], "metrics")
    found = {"volume_ratio_high_anomalous_addresses": A.volume_ratio_high(m), "volume_ratio_low_anomalous_addresses": A.volume_ratio_low(m)}
    written = SK.save_results(found, base, "2024-01-01 00:00:00")
    out = None
    for name, n in written.items():
        t = spark.read.parquet(f"{base}/{name}").select(
            F.lit(name).alias("tbl"), "id", F.round("volume_ratio", 6).alias("volume_ratio"),
            F.date_format("detection_time", "yyyy-MM-dd HH:mm:ss").alias("run"), F.lit(n).cast("long").alias("written"))
        out = t if out is None else out.unionByName(t)
    return out
