"""The hourly graph job, end to end: load trades not yet analyzed, build the
address graph, network analysis, anomaly detection, append the stamped
results, write the trades table back with the processed rows flagged.

Shared intermediates (edges, ranks, components, metrics) are computed once;
PageRank runs once per job and feeds both the ranking and the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import graph as G
from ..sources import sinks as SK
from . import q_rules


def network_analysis(trades: DataFrame, top: int = 100, communities: int = 10, multi_edges: bool = False):
    """The six network result frames plus the shared intermediates."""
    v, e, ranks, m = A.graph_metrics(trades, multi_edges=multi_edges, values=True)
    comps = G.connected_components(v, e).persist()
    results = {
        "important_addresses": G.important_addresses(v, ranks, top),
        "in_degree_addresses": G.degree_top(e, v, "in", top),
        "out_degree_addresses": G.degree_top(e, v, "out", top),
        "network_communities": G.community_sizes(comps, None),
        "community_members": G.community_members(comps, v, communities),
        "token_pairs": G.token_pairs(trades, top),
    }
    return results, {"vertices": v, "edges": e, "ranks": ranks, "metrics": m, "components": comps}


def anomaly_detection(metrics: DataFrame) -> dict:
    """Cluster, high-ratio and low-ratio anomalies (empty, full-schema frames
    when there are too few addresses to cluster)."""
    clustered, _ = A.kmeans_clusters(metrics)
    if clustered is None:
        cluster = metrics.limit(0).withColumn("prediction", F.lit(None).cast("long")) \
            .withColumn("distance_to_centroid", F.lit(None).cast("double"))
    else:
        cluster = A.cluster_anomalies(clustered)
    return {
        "graph_based_anomalous_addresses": cluster,
        "volume_ratio_high_anomalous_addresses": A.volume_ratio_high(metrics),
        "volume_ratio_low_anomalous_addresses": A.volume_ratio_low(metrics),
    }


def run_graph_job(trades_table: DataFrame, results_path: str, snapshot_path: str, as_of,
                  minutes: int = 90) -> dict:
    """Runs the job; returns the tables written and the new trades snapshot
    folder (readers switch to it; the folder being read is never
    overwritten)."""
    batch = q_rules.load_trades(trades_table, analyzed=False, as_of=as_of, minutes=minutes)
    if batch.isEmpty():
        return {"written": [], "snapshot": None}
    network, shared = network_analysis(batch)
    anomalies = anomaly_detection(shared["metrics"])
    graph_tables = {"graph_vertices": shared["vertices"], "graph_edges": shared["edges"]}
    written = SK.save_results({**graph_tables, **network, **anomalies}, results_path, as_of)
    marked = SK.mark_analyzed(trades_table, batch)
    SK.write_snapshot(marked, snapshot_path)
    shared["components"].unpersist()
    return {"written": written, "snapshot": snapshot_path}
