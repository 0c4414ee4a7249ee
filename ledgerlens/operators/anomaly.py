"""Address-level anomaly detection on the graph: metrics, standardisation,
K-means distance outliers, small clusters and volume-ratio outliers."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from . import graph as G

# shipped to Python workers by value, as in ``iforest``
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRIC_FEATURES = ["inDegree", "outDegree", "pagerank", "sent_volume", "received_volume",
                   "transactions_sent", "transactions_received"]
# Fixed values of the reference's detectors.
MIN_ADDRESSES = 20          # fewer addresses -> no clustering
MAX_K = 20                  # k = min(20, n / 5)
SMALL_CLUSTER = 10          # clusters below this size are anomalous
MAX_OUTLIERS = 500          # farthest addresses from their centroid
KMEANS_SEED = 1
KMEANS_ROUNDS = 20
HIGH_RATIO, LOW_RATIO, MIN_TX = 10.0, 0.1, 5


def address_metrics(vertices: DataFrame, edges: DataFrame, transfers: DataFrame, ranks: DataFrame,
                    sender: str = "sell_address", receiver: str = "buy_address",
                    sent_amount: str = "sell_amount", received_amount: str = "buy_amount") -> DataFrame:
    """Per vertex: its own columns plus in/out degree over ``edges`` (pass
    aggregated edges for distinct counterparties, raw edges for number of
    transfers), PageRank, sent / received volume and count over
    ``transfers``. Missing numbers are 0, strings stay null.

    Every fact is id-keyed, so instead of five left joins all facts are
    unioned as sparse rows and folded by one ``groupBy(id)`` (one shuffle,
    map-side partial aggregation; a hub is pre-aggregated per task). The vertices
    are folded by themselves and joined by the same key: their texts would make
    the aggregation of all facts a sort."""
    def fact(df, **cols):
        return df.select(F.col("id"), *[c.alias(k) for k, c in cols.items()])

    one = F.lit(1).cast("long")
    vcols = [c for c in vertices.columns if c != "id"]
    parts = [
        fact(edges.select(F.col("dst").alias("id")), inDegree=one),
        fact(edges.select(F.col("src").alias("id")), outDegree=one),
        fact(ranks, pagerank=F.col("pagerank")),
        fact(transfers.select(F.col(sender).alias("id"), F.col(sent_amount).alias("a")),
             sent_volume=F.col("a"), transactions_sent=one),
        fact(transfers.select(F.col(receiver).alias("id"), F.col(received_amount).alias("a")),
             received_volume=F.col("a"), transactions_received=one),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    known = F.col("id").isNotNull()
    facts = u.where(known).groupBy("id").agg(
        *[F.sum(c).alias(c) for c in ("inDegree", "outDegree", "transactions_sent", "transactions_received",
                                      "sent_volume", "received_volume")], F.max("pagerank").alias("pagerank"))
    # one vertex row per id; facts about ids that are not vertices are dropped
    m = vertices.where(known).groupBy("id").agg(*[F.max(c).alias(c) for c in vcols]).join(facts, "id", "left")
    numeric = [f.name for f in m.schema.fields if f.dataType.typeName() in ("long", "integer", "double")]
    return m.na.fill(0, numeric)


def transfers_from_trades(trades: DataFrame) -> DataFrame:
    """Transfer view (sender, receiver, amount, timestamp) of flat trades."""
    return trades.select(F.col("sell_address").alias("sender"), F.col("buy_address").alias("receiver"),
                         F.col("buy_amount").alias("amount"),
                         F.col("detection_time").alias("timestamp"))


def volume_ratio(metrics: DataFrame) -> DataFrame:
    """``volume_ratio`` = sent / received, 0 when nothing was received."""
    r = F.col("received_volume")
    return metrics.withColumn("volume_ratio", F.when(r > 0, F.col("sent_volume") / r).otherwise(F.lit(0.0)))


def _valid_id(df):
    return df.where(F.col("id").isNotNull() & (F.length(F.col("id").cast("string")) > 0))


def volume_ratio_high(metrics: DataFrame, high: float = HIGH_RATIO, min_tx: int | None = MIN_TX) -> DataFrame:
    """Ratio above ``high`` with something sent and (unless ``min_tx`` is
    None) more than ``min_tx`` sends. A filter over the metrics: no shuffle."""
    v = volume_ratio(metrics)
    cond = F.col("volume_ratio") > high
    if min_tx is not None:
        cond = cond & (F.col("sent_volume") > 0) & (F.col("transactions_sent") > min_tx)
    return _valid_id(v.where(cond))


def volume_ratio_low(metrics: DataFrame, low: float = LOW_RATIO, min_tx: int | None = MIN_TX) -> DataFrame:
    v = volume_ratio(metrics)
    cond = (F.col("volume_ratio") < low) & (F.col("received_volume") > 0)
    if min_tx is not None:
        cond = cond & (F.col("transactions_received") > min_tx)
    return _valid_id(v.where(cond))


def column_stats(metrics: DataFrame, cols=tuple(METRIC_FEATURES)):
    """Row count, means and sample stds in one global aggregation (partial
    per task); a fixed-size result read back to the driver."""
    return metrics.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias("m_" + c) for c in cols],
                       *[F.stddev_samp(c).alias("s_" + c) for c in cols]).first()


def zscore(metrics: DataFrame, cols=tuple(METRIC_FEATURES), prefix: str = "s_", stats=None) -> DataFrame:
    """Standardise with the mean and the sample std of the whole table; a
    zero std gives 0 (the convention of Spark ML's StandardScaler).

    The statistics are one global aggregation read back as literals: a
    fixed-size result, no cross join."""
    st = stats if stats is not None else column_stats(metrics, cols)
    out = metrics
    for c in cols:
        m, s = st["m_" + c], st["s_" + c]
        if s is None or s == 0 or m is None:
            out = out.withColumn(prefix + c, F.lit(0.0))
        else:
            out = out.withColumn(prefix + c, (F.col(c).cast("double") - F.lit(m)) / F.lit(s))
    return out


def kmeans_clusters(metrics: DataFrame, cols=tuple(METRIC_FEATURES), max_k: int = MAX_K,
                    min_rows: int = MIN_ADDRESSES, seed: int = KMEANS_SEED, rounds: int = KMEANS_ROUNDS):
    """K-means over the standardised metrics with k = min(max_k, n / 5).
    Returns ``(clustered, centers)`` where clustered has ``prediction`` and
    ``distance_to_centroid``, or ``(None, [])`` when there are fewer than
    ``min_rows`` addresses.

    Lloyd's rounds, a fixed number of them, from the k addresses with the
    smallest MD5 of "seed|id": the result is a function of the table that does
    not depend on partitions. A round finds the nearest centres a batch of rows at
    a time and is one partial aggregation whose k rows of
    means come to the driver and go back as literals; means are kept to 9
    decimals (what is below is the order of the sums), and a centre without
    members stays where it is. Features are the z-scores to 9 decimals, written
    once: a round reads nothing else."""
    # the statistics and every round read the metrics: written once (survives executor loss)
    metrics = stored(metrics, "cluster-metrics")
    st = column_stats(metrics, cols)          # one pass gives n and the scaler
    n = st["n"]
    if n < min_rows:
        return None, []
    k = max(2, min(max_k, int(n / 5)))
    scaled = [F.round("s_" + c, 9) for c in cols]
    data = stored(zscore(metrics, cols, stats=st).withColumn("scaled", F.array(*scaled)), "cluster-points")
    xs = {f"x{i}": F.col("scaled")[i] for i in range(len(cols))}
    points = stored(data.select(*[c.alias(x) for x, c in xs.items()]), "cluster-features")
    starts = data.select("id", "scaled", F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string")).cast("binary")).alias("h")) \
        .orderBy("h", "id").limit(k)
    centers = [list(r["scaled"]) for r in starts.collect()]
    for _ in range(rounds):
        near = _assigned(points, centers, [*xs]).groupBy("prediction") \
            .agg(*[F.round(F.avg(x), 9).alias(f"c{i}") for i, x in enumerate(xs)])
        moved = list(centers)
        for r in near.collect():               # k rows
            moved[r["prediction"]] = [r[f"c{i}"] for i in range(len(cols))]
        if moved == centers:                   # no later round would change anything
            break
        centers = moved
    # written once: its readers want the clusters, the distances and the rows
    return stored(_assigned(data.withColumns(xs), centers, [*xs]).drop(*xs), "clustered"), centers


def _assigned(df: DataFrame, centers, xs) -> DataFrame:
    """``df`` with the columns of ``_assign``."""
    added = [T.StructField("prediction", T.LongType()), T.StructField("distance_to_centroid", T.DoubleType())]
    return df.mapInArrow(_assign(centers, xs), T.StructType([*df.schema.fields, *added]))


def _assign(centers, xs):
    """Adds ``prediction`` and ``distance_to_centroid`` to batches with feature
    columns ``xs``: the choice of ``_nearest``, made for all rows of a batch at
    once; a missing or NaN distance is behind all others."""
    def run(frames):
        for b in frames:
            features = [b.column(x) for x in xs]
            known = reduce(np.logical_and, [f.is_valid().to_numpy(zero_copy_only=False) for f in features])
            x = [f.to_numpy(zero_copy_only=False).astype(float) for f in features]
            best, at = np.full(b.num_rows, np.nan), np.zeros(b.num_rows, dtype=np.int64)
            for i, c in enumerate(centers):
                # a NaN mean is a centre of NaN distances, as in Spark
                d = np.sqrt(reduce(np.add, [(v - float(w)) * (v - float(w)) for v, w in zip(x, c)]))
                nearer = (d < best) | (np.isnan(best) & ~np.isnan(d))
                best, at = np.where(nearer, d, best), np.where(nearer, i, at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array(best, mask=~known)],
                                             names=[*b.schema.names, "prediction", "distance_to_centroid"])
    return run


def _nearest(data: DataFrame, centers) -> DataFrame:
    def distance(c: Column) -> Column:
        squares = [(F.col("scaled")[i] - c[i]) * (F.col("scaled")[i] - c[i]) for i in range(len(centers[0]))]
        return F.sqrt(reduce(lambda a, b: a + b, squares))
    # the centres are one literal, so that the plan, and its compiled code, is the same in every round
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    near = F.array_min(F.transform(table, lambda c, i: F.struct(distance(c).alias("d"), i.cast("long").alias("i"))))
    return data.withColumn("_near", near).withColumn("prediction", F.col("_near.i")) \
        .withColumn("distance_to_centroid", F.col("_near.d")).drop("_near")


def assign_centres(metrics: DataFrame, centers, cols=tuple(METRIC_FEATURES)) -> DataFrame:
    """``prediction`` (nearest of the given standardised ``centers``, ties to the
    first) and ``distance_to_centroid`` of every address: the assignment step
    with the centres as a parameter."""
    return _nearest(zscore(metrics, cols).withColumn("scaled", F.array(*[F.col("s_" + c) for c in cols])), centers)


def small_clusters(clustered: DataFrame, small: int = SMALL_CLUSTER) -> DataFrame:
    sizes = clustered.groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))
    return sizes.where(F.col("count") < small)


def cluster_outliers(clustered: DataFrame, max_outliers: int = MAX_OUTLIERS) -> DataFrame:
    """The ``max_outliers`` addresses farthest from their centre (top-k)."""
    return clustered.orderBy(F.col("distance_to_centroid").desc(), F.col("id")).limit(max_outliers)


def cluster_anomalies(clustered: DataFrame, small: int = SMALL_CLUSTER,
                      max_outliers: int = MAX_OUTLIERS) -> DataFrame:
    """Members of clusters smaller than ``small`` plus the farthest
    ``max_outliers``, each address once. At most k <= 20 small clusters are
    broadcast; the outlier lookup is left to the planner. One filter pass: no
    union, no distinct over vectors."""
    small_ids = F.broadcast(small_clusters(clustered, small).select("prediction", F.lit(True).alias("_small")))
    far = cluster_outliers(clustered, max_outliers).select(F.col("id").alias("_fid"), F.lit(True).alias("_far"))
    j = (clustered.join(small_ids, "prediction", "left")
         .join(far, F.col("id") == F.col("_fid"), "left"))
    return (j.where(F.coalesce(F.col("_small"), F.lit(False)) | F.coalesce(F.col("_far"), F.lit(False)))
            .drop("_small", "_far", "_fid"))


GRAPH_COLUMNS = ("buy_address", "buy_amount", "buy_currency", "sell_address", "sell_amount", "sell_currency", "gas_price",
                 "block_unixtime")


def graph_metrics(trades: DataFrame, multi_edges: bool = False, values: bool = False):
    """Vertices, edges, ranks and metrics of a trade set (computed once and
    shared by every consumer). The trades are read several times: of a view that
    joins tables pass a written copy of its ``GRAPH_COLUMNS``. The edges are
    (src, dst) alone, all that the metrics read, unless their ``values`` are
    asked for."""
    # read by the ranks, the degrees and the metrics: written once
    v = stored(G.build_vertices(trades), "graph-vertices")
    e = G.trade_edges(trades) if multi_edges else G.build_edges(trades)
    e = stored(e if values else e.select("src", "dst"), "graph-edges")
    ranks = G.pagerank(v, e)
    m = address_metrics(v, e, trades, ranks)
    return v, e, ranks, m
