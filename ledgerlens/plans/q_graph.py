"""Registered queries of the graph family over the whole trades view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import graph as G
from ..session import stored
from ..sources.tables import trades
from .registry import register

# ------------------------------------------------------------------ SQL parts
_SIDES = """s AS (
  SELECT buy_address AS id, true AS b, buy_amount AS amt, buy_currency AS sym FROM trades
  UNION ALL SELECT sell_address, false, sell_amount, sell_currency FROM trades)"""

_VERTICES = _SIDES + """,
v AS (
  SELECT id, coalesce(sum(amt) FILTER (WHERE b), 0) AS total_buy_volume,
         count(*) FILTER (WHERE b) AS buy_transactions,
         coalesce(sum(amt) FILTER (WHERE NOT b), 0) AS total_sell_volume,
         count(*) FILTER (WHERE NOT b) AS sell_transactions,
         coalesce(min(sym) FILTER (WHERE b), min(sym) FILTER (WHERE NOT b)) AS symbol
  FROM s WHERE id IS NOT NULL GROUP BY id),
vx AS (SELECT *, buy_transactions + sell_transactions AS total_transactions,
              total_buy_volume + total_sell_volume AS total_volume FROM v)"""

_EDGES_AGG = """ea AS (
  SELECT sell_address AS src, buy_address AS dst, sum(buy_amount) AS total_buy_value,
         sum(sell_amount) AS total_sell_value, count(*) AS transaction_count,
         avg(gas_price) AS avg_gas_price, max(block_unixtime) AS latest_timestamp
  FROM trades WHERE sell_address IS NOT NULL AND buy_address IS NOT NULL GROUP BY 1, 2)"""


def pagerank_sql(edges: str, ids: str, iterations: int = G.PAGERANK_ITERATIONS,
                 reset: float = G.PAGERANK_RESET) -> str:
    """CTE chain computing ``pr(id, pagerank)``: the rounds unrolled, then
    scaled to sum to the vertex count. ``edges``: a relation (src, dst);
    ``ids``: a relation (id)."""
    parts = [f"od AS (SELECT src, count(*) AS deg FROM {edges} GROUP BY src)",
             f"r0 AS (SELECT id, 1.0::DOUBLE AS pr FROM {ids})"]
    for i in range(1, iterations + 1):
        parts.append(
            f"r{i} AS (SELECT i.id, {reset} + {1 - reset} * coalesce(c.s, 0) AS pr FROM {ids} i LEFT JOIN "
            f"(SELECT e.dst, sum(r.pr * (1.0 / od.deg)) AS s FROM {edges} e JOIN r{i - 1} r ON r.id = e.src "
            f"JOIN od ON od.src = e.src GROUP BY e.dst) c ON c.dst = i.id)")
    parts.append(f"pr AS (SELECT id, pr * ((SELECT count(*) FROM r{iterations}) / "
                 f"(SELECT sum(pr) FROM r{iterations})) AS pagerank FROM r{iterations})")
    return ",\n".join(parts)


_E_DISTINCT = "ed AS (SELECT DISTINCT sell_address AS src, buy_address AS dst FROM trades " \
              "WHERE sell_address IS NOT NULL AND buy_address IS NOT NULL)"
_IDS = "ids AS (SELECT id FROM vx)"

_COMPONENTS = """u AS (SELECT src AS a, dst AS b FROM ed WHERE src <> dst UNION SELECT dst, src FROM ed WHERE src <> dst),
cc(id, component) USING KEY (id) AS (
  SELECT id, id FROM ids
  UNION
  (SELECT u.b AS id, min(c.component) AS component
   FROM cc c JOIN u ON u.a = c.id JOIN recurring.cc r ON r.id = u.b
   GROUP BY u.b HAVING min(c.component) < min(r.component)))"""


def _r4(c):
    return F.round(c, 4).alias(c)


def _r6(c):
    return F.round(c, 6).alias(c)


def _graph(spark, sf):
    t = trades(spark, sf)
    return t, G.build_vertices(t), G.build_edges(t)


# ------------------------------------------------------------------ keys
@register("graph_vertices", "WITH " + _VERTICES + """
SELECT id, round(total_buy_volume, 4) AS total_buy_volume, buy_transactions,
       round(total_sell_volume, 4) AS total_sell_volume, sell_transactions, symbol, total_transactions,
       round(total_volume, 4) AS total_volume FROM vx""")
def q_graph_vertices(spark, sf):
    _, v, _ = _graph(spark, sf)
    return v.select("id", _r4("total_buy_volume"), "buy_transactions", _r4("total_sell_volume"),
                    "sell_transactions", "symbol", "total_transactions", _r4("total_volume"))


@register("graph_edges", "WITH " + _EDGES_AGG + """
SELECT src, dst, round(total_buy_value, 4) AS total_buy_value, round(total_sell_value, 4) AS total_sell_value,
       transaction_count, round(avg_gas_price, 6) AS avg_gas_price, latest_timestamp,
       CAST(transaction_count AS DOUBLE) AS weight FROM ea""")
def q_graph_edges(spark, sf):
    _, _, e = _graph(spark, sf)
    return e.select("src", "dst", _r4("total_buy_value"), _r4("total_sell_value"), "transaction_count",
                    _r6("avg_gas_price"), "latest_timestamp", "weight")


@register("in_degree_top", "WITH " + _VERTICES + "," + _EDGES_AGG + """
SELECT d.id, vx.symbol, d.inDegree FROM (SELECT dst AS id, count(*) AS inDegree FROM ea GROUP BY dst) d
JOIN vx ON vx.id = d.id ORDER BY d.inDegree DESC, d.id LIMIT 100""")
def q_in_degree_top(spark, sf):
    _, v, e = _graph(spark, sf)
    return G.degree_top(e, v, "in", 100)


@register("out_degree_top", "WITH " + _VERTICES + "," + _EDGES_AGG + """
SELECT d.id, vx.symbol, d.outDegree FROM (SELECT src AS id, count(*) AS outDegree FROM ea GROUP BY src) d
JOIN vx ON vx.id = d.id ORDER BY d.outDegree DESC, d.id LIMIT 100""")
def q_out_degree_top(spark, sf):
    _, v, e = _graph(spark, sf)
    return G.degree_top(e, v, "out", 100)


@register("token_pairs", """
SELECT buy_currency AS buy_token, sell_currency AS sell_token, count(*) AS count FROM trades
GROUP BY 1, 2 ORDER BY count DESC, buy_token NULLS FIRST, sell_token NULLS FIRST LIMIT 100""")
def q_token_pairs(spark, sf):
    return G.token_pairs(trades(spark, sf), 100)


_PR_SQL = "WITH " + _VERTICES + ",\n" + _E_DISTINCT + ",\n" + _IDS + ",\n" + pagerank_sql("ed", "ids")


@register("pagerank", _PR_SQL + "\nSELECT id, round(pagerank, 6) AS pagerank FROM pr")
def q_pagerank(spark, sf):
    _, v, e = _graph(spark, sf)
    return G.pagerank(v, e).select("id", _r6("pagerank"))


@register("important_addresses", _PR_SQL + """
SELECT vx.id, vx.symbol, round(pr.pagerank, 6) AS pagerank, vx.total_transactions,
       round(vx.total_volume, 4) AS total_volume
FROM vx JOIN pr ON pr.id = vx.id ORDER BY round(pr.pagerank, 6) DESC, vx.id LIMIT 100""")
def q_important_addresses(spark, sf):
    _, v, e = _graph(spark, sf)
    r = G.pagerank(v, e).select("id", _r6("pagerank"))
    return G.important_addresses(v, r, 100).select("id", "symbol", "pagerank", "total_transactions",
                                                    _r4("total_volume"))


_CC_SQL = "WITH RECURSIVE " + _VERTICES + ",\n" + _E_DISTINCT + ",\n" + _IDS + ",\n" + _COMPONENTS


@register("connected_components", _CC_SQL + "\nSELECT id, component FROM cc")
def q_connected_components(spark, sf):
    _, v, e = _graph(spark, sf)
    return G.connected_components(v, e)


@register("community_sizes", _CC_SQL + """
SELECT component, count(*) AS count FROM cc GROUP BY component ORDER BY count DESC, component LIMIT 10""")
def q_community_sizes(spark, sf):
    _, v, e = _graph(spark, sf)
    return G.community_sizes(G.connected_components(v, e), 10)


@register("community_members", _CC_SQL + """,
top AS (SELECT component, count(*) AS n FROM cc GROUP BY component ORDER BY n DESC, component LIMIT 10)
SELECT cc.id, cc.component, coalesce(vx.symbol, '') AS symbol, vx.total_transactions,
       round(vx.total_volume, 4) AS total_volume
FROM cc JOIN top ON top.component = cc.component JOIN vx ON vx.id = cc.id""")
def q_community_members(spark, sf):
    _, v, e = _graph(spark, sf)
    m = G.community_members(G.connected_components(v, e), v, 10)
    return m.select("id", "component", "symbol", "total_transactions", _r4("total_volume"))


# The trades of one month: a sparse slice that falls into some 30 components.
_SLICE = "detection_time >= TIMESTAMP '1999-01-01 00:00:00' AND detection_time < TIMESTAMP '1999-02-01 00:00:00'"
_SLICE_SQL = "WITH RECURSIVE st AS (SELECT * FROM trades WHERE " + _SLICE + "),\n" + \
    (_VERTICES + ",\n" + _E_DISTINCT + ",\n" + _IDS).replace("FROM trades", "FROM st") + ",\n" + _COMPONENTS


@register("component_sizes_sparse", _SLICE_SQL + """,
n AS (SELECT component, count(*) AS members FROM cc GROUP BY component)
SELECT component, members, count(*) OVER () AS components FROM n""")
def q_component_sizes_sparse(spark, sf):
    """Components of a sparse slice of the graph with their sizes."""
    t = trades(spark, sf).where(F.expr(_SLICE))
    sizes = G.community_sizes(G.connected_components(G.build_vertices(t), G.build_edges(t)), None)
    total = sizes.select(F.count(F.lit(1))).scalar()
    return sizes.select("component", F.col("count").alias("members"), total.alias("components"))


# ------------------------------------------------------------------ metrics
_METRIC_COLS = ["id", "total_buy_volume", "buy_transactions", "total_sell_volume", "sell_transactions", "symbol",
                "total_transactions", "total_volume", "inDegree", "outDegree", "pagerank", "sent_volume",
                "transactions_sent", "received_volume", "transactions_received"]
_ROUND4 = {"total_buy_volume", "total_sell_volume", "total_volume", "sent_volume", "received_volume"}


def _metrics_sql(edges: str) -> str:
    return f"""
m AS (
  SELECT vx.*, coalesce(i.n, 0) AS inDegree, coalesce(o.n, 0) AS outDegree, coalesce(pr.pagerank, 0) AS pagerank,
         coalesce(sv.v, 0) AS sent_volume, coalesce(sv.n, 0) AS transactions_sent,
         coalesce(rv.v, 0) AS received_volume, coalesce(rv.n, 0) AS transactions_received
  FROM vx
  LEFT JOIN (SELECT dst, count(*) AS n FROM {edges} GROUP BY dst) i ON i.dst = vx.id
  LEFT JOIN (SELECT src, count(*) AS n FROM {edges} GROUP BY src) o ON o.src = vx.id
  LEFT JOIN pr ON pr.id = vx.id
  LEFT JOIN (SELECT sell_address AS a, sum(sell_amount) AS v, count(*) AS n FROM trades GROUP BY 1) sv ON sv.a = vx.id
  LEFT JOIN (SELECT buy_address AS a, sum(buy_amount) AS v, count(*) AS n FROM trades GROUP BY 1) rv ON rv.a = vx.id)"""


def _metrics_select(src="m"):
    cols = []
    for c in _METRIC_COLS:
        if c in _ROUND4:
            cols.append(f"round({c}, 4) AS {c}")
        elif c == "pagerank":
            cols.append("round(pagerank, 6) AS pagerank")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


def _metrics_spark(m):
    return m.select(*[_r4(c) if c in _ROUND4 else (_r6(c) if c == "pagerank" else F.col(c))
                      for c in _METRIC_COLS])


_E_RAW = "er AS (SELECT sell_address AS src, buy_address AS dst FROM trades " \
         "WHERE sell_address IS NOT NULL AND buy_address IS NOT NULL)"
_M_SQL = _PR_SQL + "," + _metrics_sql("ed")
_TM_SQL = ("WITH " + _VERTICES + ",\n" + _E_RAW + ",\n" + _IDS + ",\n" + pagerank_sql("er", "ids")
           + "," + _metrics_sql("er"))


def graph_trades(spark, sf):
    """The columns that the graph reads of the trades view, written once: every
    step would join the tables again."""
    return stored(trades(spark, sf).select(*A.GRAPH_COLUMNS), "graph-trades")


def _metrics(spark, sf, multi_edges=False):
    return A.graph_metrics(graph_trades(spark, sf), multi_edges=multi_edges)[3]


@register("address_metrics", _M_SQL + "\n" + _metrics_select())
def q_address_metrics(spark, sf):
    return _metrics_spark(_metrics(spark, sf))


@register("transfer_metrics", _TM_SQL + "\n" + _metrics_select())
def q_transfer_metrics(spark, sf):
    """Metrics over raw transfers: degree = number of transfers, PageRank
    over the multi-edges (the older variant's semantics)."""
    return _metrics_spark(_metrics(spark, sf, multi_edges=True))


_Z_COLS = A.METRIC_FEATURES


@register("address_zscore", _M_SQL + f"""
SELECT id, {', '.join(
    f"round(CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0.0 ELSE "
    f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 6) + 0.0 AS s_{c}" for c in _Z_COLS)}
FROM m""")
def q_address_zscore(spark, sf):
    z = A.zscore(stored(_metrics(spark, sf), "metrics"), _Z_COLS)
    return z.select("id", *[_r6("s_" + c) for c in _Z_COLS])


_RATIO_OUT = ("id, round(volume_ratio, 6) AS volume_ratio, round(sent_volume, 4) AS sent_volume, "
              "round(received_volume, 4) AS received_volume, transactions_sent, transactions_received")


def _ratio_sql(base, cond):
    return base + f""",
vr AS (SELECT *, CASE WHEN received_volume > 0 THEN sent_volume / received_volume ELSE 0.0 END AS volume_ratio FROM m)
SELECT {_RATIO_OUT} FROM vr WHERE {cond} AND id IS NOT NULL AND length(id) > 0"""


def _ratio_spark(df):
    return df.select("id", _r6("volume_ratio"), _r4("sent_volume"), _r4("received_volume"),
                     "transactions_sent", "transactions_received")


@register("volume_ratio_high", _ratio_sql(_M_SQL, "volume_ratio > 10 AND sent_volume > 0 AND transactions_sent > 5"))
def q_volume_ratio_high(spark, sf):
    return _ratio_spark(A.volume_ratio_high(_metrics(spark, sf)))


@register("volume_ratio_low",
          _ratio_sql(_M_SQL, "volume_ratio < 0.1 AND received_volume > 0 AND transactions_received > 5"))
def q_volume_ratio_low(spark, sf):
    return _ratio_spark(A.volume_ratio_low(_metrics(spark, sf)))


@register("transfer_ratio_high", _ratio_sql(_TM_SQL, "volume_ratio > 10"))
def q_transfer_ratio_high(spark, sf):
    return _ratio_spark(A.volume_ratio_high(_metrics(spark, sf, True), min_tx=None))


@register("transfer_ratio_low", _ratio_sql(_TM_SQL, "volume_ratio < 0.1 AND received_volume > 0"))
def q_transfer_ratio_low(spark, sf):
    return _ratio_spark(A.volume_ratio_low(_metrics(spark, sf, True), min_tx=None))


# ------------------------------------------------------------------ K-means
_CLUSTER_OUT = ["id", "prediction", "distance_to_centroid", "inDegree", "outDegree", "transactions_sent", "transactions_received"]


def kmeans_sql(metrics: str, rounds: int = A.KMEANS_ROUNDS) -> str:
    """CTE chain that ends in ``cl(id, prediction, d)``: the rounds unrolled."""
    xs = [f"x{i}" for i in range(len(_Z_COLS))]
    near = f"sqrt({' + '.join(f'(p.{x} - c.{x}) * (p.{x} - c.{x})' for x in xs)})"
    parts = [f"""
kz AS MATERIALIZED (SELECT id, {', '.join(
        f"round(CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 9)"
        f" AS {x}" for c, x in zip(_Z_COLS, xs))} FROM {metrics}),
kc0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, id) - 1 AS i, {', '.join(xs)} FROM (SELECT *, md5('{A.KMEANS_SEED}|' || id) AS h FROM kz)
  QUALIFY i < greatest(2, least({A.MAX_K}, (SELECT count(*) FROM kz) // 5)))"""]
    for r in range(rounds):
        parts.append(f"""
ka{r} AS MATERIALIZED (SELECT p.id, arg_min(c.i, struct_pack(d := {near}, i := c.i)) AS i FROM kz p, kc{r} c GROUP BY p.id),
kc{r + 1} AS MATERIALIZED (SELECT c.i, {', '.join(f'coalesce(n.{x}, c.{x}) AS {x}' for x in xs)} FROM kc{r} c LEFT JOIN
  (SELECT i, {', '.join(f'round(avg({x}), 9) AS {x}' for x in xs)} FROM ka{r} JOIN kz USING (id) GROUP BY i) n ON n.i = c.i)""")
    parts.append(f"""
cl AS MATERIALIZED (SELECT p.id, arg_min(c.i, struct_pack(d := {near}, i := c.i))::BIGINT AS prediction, round(min({near}), 6) AS d
  FROM kz p, kc{rounds} c GROUP BY p.id)""")
    return ",".join(parts)


_KM_SQL = _M_SQL + "," + kmeans_sql("m")
_KM_OUT = ", ".join(["cl.id", "prediction", "d AS distance_to_centroid", *[f"m.{c}" for c in _CLUSTER_OUT[3:]]])
_FAR = "(SELECT id FROM cl ORDER BY d DESC, id LIMIT 500)"
_FEW = "(SELECT prediction FROM cl GROUP BY prediction HAVING count(*) < 10)"


def _clustered(spark, sf):
    clustered, _ = A.kmeans_clusters(_metrics(spark, sf))
    return clustered.withColumn("distance_to_centroid", F.round("distance_to_centroid", 6))


@register("cluster_distance", _KM_SQL + f"\nSELECT {_KM_OUT} FROM cl JOIN m USING (id)")
def q_cluster_distance(spark, sf):
    return _clustered(spark, sf).select(*_CLUSTER_OUT)


@register("small_clusters", _KM_SQL + "\nSELECT prediction, count(*) AS count FROM cl GROUP BY prediction HAVING count(*) < 10")
def q_small_clusters(spark, sf):
    return A.small_clusters(_clustered(spark, sf))


@register("cluster_outliers", _KM_SQL + f"\nSELECT {_KM_OUT} FROM cl JOIN m USING (id) WHERE cl.id IN {_FAR}")
def q_cluster_outliers(spark, sf):
    return A.cluster_outliers(_clustered(spark, sf)).select(*_CLUSTER_OUT)


@register("cluster_anomalies", _KM_SQL + f"\nSELECT {_KM_OUT} FROM cl JOIN m USING (id) WHERE cl.id IN {_FAR} OR prediction IN {_FEW}")
def q_cluster_anomalies(spark, sf):
    return A.cluster_anomalies(_clustered(spark, sf)).select(*_CLUSTER_OUT)


# ------------------------------------------------------------------ the same steps on given centres
# Five fixed centres in units of standard deviations, so that the assignment is
# the same in any engine; the clusters from K-means go through the same code.
_CENTRES = [[0.0] * 7, [1.5, -0.5, 1.0, 0.0, 1.0, 0.0, 1.5], [-0.5, 1.5, -0.5, 1.5, 0.0, 1.5, -0.5],
            [-1.5, 0.0, -1.0, 0.0, -1.0, 0.0, -1.5], [4.5, 0.0, 4.5, 0.0, 4.5, 0.0, 4.5]]
_GIVEN_SQL = _M_SQL + f""",
zs AS (SELECT id, {', '.join(
    f"(CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0.0 ELSE "
    f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END) AS s_{c}" for c in _Z_COLS)} FROM m),
dd AS ({' UNION ALL '.join(
    f"SELECT id, {i}::BIGINT AS prediction, sqrt({' + '.join(f'(s_{c} - {x}) * (s_{c} - {x})' for c, x in zip(_Z_COLS, centre))}) AS d FROM zs"
    for i, centre in enumerate(_CENTRES))}),
cl AS (SELECT id, prediction, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, prediction) AS rn FROM dd)
  WHERE rn = 1),
sc AS (SELECT prediction, count(*) AS count FROM cl GROUP BY prediction HAVING count(*) < 10),
far AS (SELECT * FROM cl ORDER BY round(d, 6) DESC, id LIMIT 100)"""


def _given(spark, sf):
    # read for the statistics and for the assignment
    g = A.assign_centres(stored(_metrics(spark, sf), "metrics"), _CENTRES)
    return g.withColumn("distance_to_centroid", F.round("distance_to_centroid", 6))


@register("given_centre_distance", _GIVEN_SQL + "\nSELECT id, prediction, round(d, 6) AS distance_to_centroid FROM cl")
def q_given_centre_distance(spark, sf):
    return _given(spark, sf).select("id", "prediction", "distance_to_centroid")


@register("given_small_clusters", _GIVEN_SQL + "\nSELECT prediction, count FROM sc")
def q_given_small_clusters(spark, sf):
    return A.small_clusters(_given(spark, sf))


@register("given_cluster_outliers", _GIVEN_SQL + "\nSELECT id, prediction, round(d, 6) AS distance_to_centroid FROM far")
def q_given_cluster_outliers(spark, sf):
    return A.cluster_outliers(_given(spark, sf), 100).select("id", "prediction", "distance_to_centroid")


@register("given_cluster_anomalies", _GIVEN_SQL + """
SELECT id, prediction, round(d, 6) AS distance_to_centroid FROM cl
WHERE prediction IN (SELECT prediction FROM sc) OR id IN (SELECT id FROM far)""")
def q_given_cluster_anomalies(spark, sf):
    return A.cluster_anomalies(_given(spark, sf), max_outliers=100).select("id", "prediction", "distance_to_centroid")
