"""Registered queries: top-N extract, sinks (analyzed flag, conform, run
summary) and cross-pipeline findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import expressions as X
from ..operators import anomaly as A
from ..operators import extract as EX
from ..operators import features as FT
from ..operators import findings as FN
from ..operators import graph as G
from ..session import stored
from ..sources import sinks as SK
from ..sources.tables import trades
from . import q_features as QF
from . import q_graph as QG
from . import q_rules as QR
from .registry import register

# --------------------------------------------------------------- extract
_TOPV_SQL = "WITH " + QG._VERTICES + ",\n" + QG._EDGES_AGG + """,
tv AS (SELECT id, round(total_volume, 4) AS total_volume, total_transactions, symbol,
              round(coalesce(total_buy_volume, 0), 4) AS total_buy_volume,
              round(coalesce(total_sell_volume, 0), 4) AS total_sell_volume
       FROM vx ORDER BY vx.total_volume DESC, id LIMIT 500),
ie AS (SELECT * FROM ea WHERE src IN (SELECT id FROM tv) AND dst IN (SELECT id FROM tv))"""


def _top(spark, sf):
    t = QG.graph_trades(spark, sf)
    v, e = G.build_vertices(t), G.build_edges(t)
    # few rows that every later step reads: read back, they also thin the trades before the edges are grouped
    top = EX.top_vertices(v, 500).withColumn("total_volume", F.round("total_volume", 4)) \
        .withColumn("total_buy_volume", F.round("total_buy_volume", 4)) \
        .withColumn("total_sell_volume", F.round("total_sell_volume", 4))
    return stored(top, "top-vertices"), e


@register("viz_top_vertices", _TOPV_SQL + "\nSELECT * FROM tv")
def q_viz_top_vertices(spark, sf):
    return _top(spark, sf)[0]


@register("viz_induced_edges", _TOPV_SQL + """
SELECT src, dst, CAST(transaction_count AS DOUBLE) AS weight, round(total_buy_value, 4) AS total_buy_value,
       round(total_sell_value, 4) AS total_sell_value, transaction_count, round(avg_gas_price, 6) AS avg_gas_price
FROM ie""")
def q_viz_induced_edges(spark, sf):
    top, e = _top(spark, sf)
    ie = EX.induced_edges(e, top)
    return ie.select("src", "dst", "weight", F.round("total_buy_value", 4).alias("total_buy_value"),
                     F.round("total_sell_value", 4).alias("total_sell_value"), "transaction_count",
                     F.round("avg_gas_price", 6).alias("avg_gas_price"))


def _deg_sql(key, name):
    return _TOPV_SQL + f"""
SELECT tv.id, substr(tv.id, 1, 10) || '...' || right(tv.id, 8) AS short_id, tv.symbol,
       coalesce(d.n, 0) AS {name}, tv.total_volume AS volume
FROM tv LEFT JOIN (SELECT {key} AS id, count(DISTINCT (src, dst)) AS n FROM ie GROUP BY 1) d ON d.id = tv.id
ORDER BY {name} DESC, tv.id LIMIT 10"""


@register("viz_hubs", _deg_sql("src", "out_degree"))
def q_viz_hubs(spark, sf):
    top, e = _top(spark, sf)
    return EX.hubs(EX.induced_edges(e, top), top, 10)


@register("viz_authorities", _deg_sql("dst", "in_degree"))
def q_viz_authorities(spark, sf):
    top, e = _top(spark, sf)
    return EX.authorities(EX.induced_edges(e, top), top, 10)


@register("viz_vertex_style", _TOPV_SQL + """
SELECT id, symbol, total_volume,
       round(CASE WHEN (SELECT max(total_volume) FROM tv) > 0
             THEN ln(1 + total_volume) / ln(1 + (SELECT max(total_volume) FROM tv)) * 25 + 5 ELSE 5 END, 6) AS size,
       CASE WHEN symbol IS NOT NULL AND symbol <> ''
            THEN dense_rank() OVER (ORDER BY CASE WHEN symbol IS NOT NULL AND symbol <> '' THEN symbol END
                                    NULLS LAST) - 1
            ELSE 0 END AS color_index
FROM tv""")
def q_viz_vertex_style(spark, sf):
    top, _ = _top(spark, sf)
    s = EX.vertex_style(top)
    return s.select("id", "symbol", "total_volume", F.round("size", 6).alias("size"), "color_index")


@register("viz_edge_style", _TOPV_SQL + """
SELECT src, dst, CAST(transaction_count AS DOUBLE) AS weight,
       round(least(0.8, greatest(0.1, transaction_count / (SELECT max(transaction_count) FROM ie))), 6) AS opacity,
       round(1 + 3 * transaction_count / (SELECT max(transaction_count) FROM ie), 6) AS width
FROM ie""")
def q_viz_edge_style(spark, sf):
    top, e = _top(spark, sf)
    s = EX.edge_style(stored(EX.induced_edges(e, top), "induced-edges"))
    return s.select("src", "dst", "weight", F.round("opacity", 6).alias("opacity"),
                    F.round("width", 6).alias("width"))


@register("viz_volume_ladder", _TOPV_SQL + """,
b AS (SELECT min(total_volume) AS lo, max(total_volume) AS hi FROM tv),
st AS (SELECT i::INTEGER AS step,
              lo + (CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE i::DOUBLE * (1.0::DOUBLE / 9.0::DOUBLE) END) * (hi - lo)
                AS threshold
       FROM range(10) r(i), b),
em AS (SELECT least(s.total_volume, d.total_volume) AS m FROM ie JOIN tv s ON s.id = ie.src JOIN tv d ON d.id = ie.dst)
SELECT step, round(threshold, 4) AS threshold,
       (SELECT count(*) FROM tv WHERE tv.total_volume >= st.threshold) AS visible_vertices,
       (SELECT count(*) FROM em WHERE em.m >= st.threshold) AS visible_edges
FROM st""")
def q_viz_volume_ladder(spark, sf):
    top, e = _top(spark, sf)
    lad = EX.volume_ladder(top, EX.induced_edges(e, top), 10)
    return lad.select("step", F.round("threshold", 4).alias("threshold"), "visible_vertices", "visible_edges")


# --------------------------------------------------------------- sinks
@register("mark_analyzed", f"""
SELECT tx_hash, block_unixtime, buy_address,
       analyzed OR tx_hash IN (SELECT tx_hash FROM trades WHERE NOT analyzed AND detection_time < {QR._CUT})
         AS analyzed
FROM trades""")
def q_mark_analyzed(spark, sf):
    t = trades(spark, sf)
    processed = QR.load_trades(t, analyzed=False)
    return SK.mark_analyzed(t, processed).select("tx_hash", "block_unixtime", "buy_address", "analyzed")


@register("conform_trades", """
SELECT protocol, block_unixtime, block_height, tx_hash, buy_currency, buy_address, round(buy_amount, 4) AS buy_amount,
       sell_currency, sell_address, round(sell_amount, 4) AS sell_amount, gas_value, gas_price,
       CAST(NULL AS DOUBLE) AS anomaly_score, CAST(NULL AS VARCHAR) AS reason, false AS analyzed
FROM trades""")
def q_conform_trades(spark, sf):
    """Feature rows projected onto the 21-column trades table (columns it
    lacks dropped, missing ones null, types cast)."""
    c = schemas.conform(FT.extract_features(trades(spark, sf)), schemas.FLAT_TRADE)
    return c.select("protocol", "block_unixtime", "block_height", "tx_hash", "buy_currency", "buy_address",
                    F.round("buy_amount", 4).alias("buy_amount"), "sell_currency", "sell_address",
                    F.round("sell_amount", 4).alias("sell_amount"), "gas_value", "gas_price",
                    "anomaly_score", "reason", "analyzed")


_RUN_SQL = QG._CC_SQL + ",\n" + QG.pagerank_sql("ed", "ids") + "," + QG._metrics_sql("ed") + "," + QG.kmeans_sql("m") + f""",
vr AS (SELECT *, CASE WHEN received_volume > 0 THEN sent_volume / received_volume ELSE 0.0 END AS volume_ratio FROM m)
SELECT (SELECT count(*) FROM vx) AS vertices, (SELECT count(*) FROM ed) AS edges,
       (SELECT count(DISTINCT component) FROM cc) AS communities,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM cc GROUP BY component)) AS largest_community,
       (SELECT id FROM pr ORDER BY round(pagerank, 6) DESC, id LIMIT 1) AS top_address,
       (SELECT count(*) FROM cl WHERE id IN {QG._FAR} OR prediction IN {QG._FEW})
       + (SELECT count(*) FROM vr WHERE volume_ratio > 10 AND sent_volume > 0 AND transactions_sent > 5)
       + (SELECT count(*) FROM vr WHERE volume_ratio < 0.1 AND received_volume > 0 AND transactions_received > 5) AS anomalies"""


@register("run_summary", _RUN_SQL)
def q_run_summary(spark, sf):
    """One-row summary of a graph run: sizes, communities, top address, and
    anomalies (cluster + both ratio tables). Scalar subqueries, no joins; the
    metrics are written once for the fit and the ratio tables."""
    v, e, ranks, m = A.graph_metrics(QG.graph_trades(spark, sf))
    m = stored(m, "metrics")
    sizes = G.community_sizes(G.connected_components(v, e), None)
    clustered, _ = A.kmeans_clusters(m)
    n_cluster = F.lit(0).cast("long")
    if clustered is not None:
        far = A.cluster_anomalies(clustered.withColumn("distance_to_centroid", F.round("distance_to_centroid", 6)))
        n_cluster = far.select(F.count(F.lit(1))).scalar()
    top = G.important_addresses(v, ranks.withColumn("pagerank", F.round("pagerank", 6)), 1)
    return spark.range(1).select(
        v.select(F.count(F.lit(1))).scalar().alias("vertices"),
        e.select(F.count(F.lit(1))).scalar().alias("edges"),
        sizes.select(F.count(F.lit(1))).scalar().alias("communities"),
        sizes.select(F.max("count")).scalar().alias("largest_community"),
        top.select("id").scalar().alias("top_address"),
        (n_cluster + A.volume_ratio_high(m).select(F.count(F.lit(1))).scalar()
         + A.volume_ratio_low(m).select(F.count(F.lit(1))).scalar()).alias("anomalies"))


# --------------------------------------------------------------- findings
_FIND_SQL = QF._Z_SQL.replace("WITH f AS", "WITH zf AS").replace("FROM f)", "FROM zf)") + f""",
za AS (SELECT tx_hash, block_unixtime, greatest({QF._ABSZ}) > 3 AS is_anomaly FROM z),
rs AS (SELECT tx_hash, block_unixtime, buy_amount, sell_amount, buy_currency, sell_currency,
              count(tx_hash) OVER (PARTITION BY tx_hash ORDER BY block_unixtime
                                   RANGE BETWEEN 180 PRECEDING AND CURRENT ROW) AS n FROM trades),
rf AS (SELECT tx_hash, block_unixtime,
              coalesce(buy_amount > 1000000 AND NOT isnan(buy_amount), false)
              OR coalesce(sell_amount > 1000000 AND NOT isnan(sell_amount), false)
              OR coalesce(buy_currency = sell_currency, false) OR n > 3
              OR buy_amount IS NULL OR buy_amount < 0.01 AS is_fraud FROM rs),
""" + QG._VERTICES.replace("s AS (", "sd AS (", 1).replace("FROM s WHERE", "FROM sd WHERE") + ",\n" + \
    QG._E_DISTINCT + ",\n" + QG._IDS + ",\n" + QG.pagerank_sql("ed", "ids") + "," + QG._metrics_sql("ed") + """,
vr AS (SELECT *, CASE WHEN received_volume > 0 THEN sent_volume / received_volume ELSE 0.0 END AS volume_ratio FROM m),
fl AS (SELECT id FROM vr WHERE (volume_ratio > 10 AND sent_volume > 0 AND transactions_sent > 5)
                            OR (volume_ratio < 0.1 AND received_volume > 0 AND transactions_received > 5)),
gf AS (SELECT tx_hash, sell_address IN (SELECT id FROM fl) OR buy_address IN (SELECT id FROM fl) AS graph_flag
       FROM trades),
cr AS (
  SELECT coalesce(r.tx_hash, s.tx_hash, g.tx_hash) AS tx_hash, coalesce(r.rule_flag, false) AS rule_flag,
         coalesce(s.stream_flag, false) AS stream_flag, coalesce(g.graph_flag, false) AS graph_flag,
         least(r.t1, s.t2) AS first_seen
  FROM (SELECT tx_hash, bool_or(is_fraud) AS rule_flag, min(block_unixtime) AS t1 FROM rf GROUP BY 1) r
  FULL JOIN (SELECT tx_hash, bool_or(is_anomaly) AS stream_flag, min(block_unixtime) AS t2 FROM za GROUP BY 1) s
    ON s.tx_hash = r.tx_hash
  FULL JOIN (SELECT tx_hash, bool_or(graph_flag) AS graph_flag FROM gf GROUP BY 1) g
    ON g.tx_hash = coalesce(r.tx_hash, s.tx_hash)),
crp AS (SELECT *, rule_flag::INTEGER + stream_flag::INTEGER + graph_flag::INTEGER AS pipelines FROM cr)"""


def _correlated(spark, sf):
    # the three pipelines read the same trades: written once
    t = stored(trades(spark, sf), "trades")
    rule = QR._flat_scored_from_trades(t)
    z = FT.window_zscore(FT.extract_features(t), QF.WINDOW)
    stream = z.select("tx_hash", "block_unixtime",
                      (F.greatest(*[F.abs(F.col("z_" + c)) for c in X.STREAM_FEATURES]) > 3).alias("is_anomaly"))
    _, _, _, m = A.graph_metrics(t)
    m = stored(m.select("id", "sent_volume", "received_volume", "transactions_sent", "transactions_received"), "metrics")
    flagged = A.volume_ratio_high(m).select("id").unionByName(A.volume_ratio_low(m).select("id"))
    graph = FN.graph_trade_flags(t, flagged)
    return FN.correlate(rule, stream, graph)


@register("correlate_findings", _FIND_SQL + "\nSELECT tx_hash, rule_flag, stream_flag, graph_flag, first_seen, "
          "pipelines FROM crp")
def q_correlate_findings(spark, sf):
    return _correlated(spark, sf).select("tx_hash", "rule_flag", "stream_flag", "graph_flag", "first_seen",
                                         "pipelines")


@register("findings_report", _FIND_SQL + """,
st AS (SELECT CAST(CAST(make_timestamp(first_seen * 1000000) AS DATE) AS VARCHAR) AS day,
              unnest(['rule_flag', 'stream_flag', 'graph_flag']) AS pipeline,
              unnest([rule_flag, stream_flag, graph_flag]) AS flag FROM crp)
SELECT day, pipeline, count(*) AS flagged FROM st WHERE flag GROUP BY 1, 2""")
def q_findings_report(spark, sf):
    return FN.report(_correlated(spark, sf))


@register("alerts", _FIND_SQL + "\nSELECT tx_hash, rule_flag, stream_flag, graph_flag, pipelines FROM crp "
          "WHERE pipelines >= 2")
def q_alerts(spark, sf):
    return FN.alerts(_correlated(spark, sf)).select("tx_hash", "rule_flag", "stream_flag", "graph_flag",
                                                     "pipelines")
