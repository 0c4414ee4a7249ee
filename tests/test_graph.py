import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import anomaly as A
from ledgerlens.operators import graph as G

TR = "tx_hash string, sell_address string, buy_address string, buy_amount double, sell_amount double, " \
     "buy_currency string, sell_currency string, gas_price double, block_unixtime long"


def _trades(spark, pairs):
    return spark.createDataFrame([(f"t{i}", s, d, 1.0, 2.0, "B", "S", 1.0, i) for i, (s, d) in enumerate(pairs)], TR)


def _numpy_pagerank(ids, edges, reset=0.15, it=10):
    idx = {v: i for i, v in enumerate(ids)}
    r = np.ones(len(ids))
    deg = {}
    for s, _ in edges:
        deg[s] = deg.get(s, 0) + 1
    for _ in range(it):
        c = np.zeros(len(ids))
        for s, d in edges:
            c[idx[d]] += r[idx[s]] / deg[s]
        r = reset + (1 - reset) * c
    return dict(zip(ids, r * len(ids) / r.sum()))


def test_vertices_union_distinct_and_symbols(spark):
    t = _trades(spark, [("a", "b"), ("b", "c"), ("a", "c"), (None, "c")])
    v = {r.id: r for r in G.build_vertices(t).collect()}
    assert sorted(v) == ["a", "b", "c"]                      # b buys and sells: one row
    assert v["b"].buy_transactions == 1 and v["b"].sell_transactions == 1 and v["b"].symbol == "B"
    assert v["a"].symbol == "S" and v["c"].total_buy_volume == 3.0 and v["c"].total_transactions == 3


def test_pagerank_matches_power_iteration_and_salting(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "e"), ("x", "x"), ("a", "c")]
    t = _trades(spark, pairs)
    v, e = G.build_vertices(t), G.build_edges(t)
    ids = sorted(r.id for r in v.collect())
    want = _numpy_pagerank(ids, sorted(set(pairs)))
    for hot in (1 << 16, 1):                                  # hot_degree=1 salts every source
        got = {r.id: r.pagerank for r in G.pagerank(v, e, hot_degree=hot).collect()}
        assert all(abs(got[k] - want[k]) < 1e-9 for k in ids)
        assert abs(sum(got.values()) - len(ids)) < 1e-9


def test_components_known_graphs(spark):
    pairs = [("a1", "a2"), ("a2", "a3"), ("a3", "a4"), ("a4", "a5"),     # chain
             ("s0", "s1"), ("s0", "s2"), ("s0", "s3"),                   # star
             ("c1", "c2"), ("c2", "c3"), ("c3", "c1"),                   # cycle
             ("z9", "z1"),                                               # sink / reversed direction
             ("iso", "iso")]                                             # self loop only
    t = _trades(spark, pairs)
    v, e = G.build_vertices(t), G.build_edges(t)
    comp = {r.id: r.component for r in G.connected_components(v, e).collect()}
    assert {comp[x] for x in ["a1", "a2", "a3", "a4", "a5"]} == {"a1"}
    assert {comp[x] for x in ["s0", "s1", "s2", "s3"]} == {"s0"}
    assert {comp[x] for x in ["c1", "c2", "c3"]} == {"c1"}
    assert comp["z9"] == "z1" and comp["iso"] == "iso"
    sizes = G.community_sizes(G.connected_components(v, e), 2).collect()
    assert [(r.component, r["count"]) for r in sizes] == [("a1", 5), ("s0", 4)]


def test_components_long_chain_converges(spark):
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)]
    t = _trades(spark, pairs)
    comp = G.connected_components(G.build_vertices(t), G.build_edges(t))
    assert comp.select("component").distinct().collect()[0][0] == "n000"


def test_degrees_and_ratio_thresholds(spark):
    pairs = [("a", "b")] * 3 + [("a", "c")]
    t = _trades(spark, pairs)
    e = G.build_edges(t)
    assert {r.id: r.outDegree for r in G.out_degrees(e).collect()} == {"a": 2}
    assert {r.id: r.outDegree for r in G.out_degrees(G.trade_edges(t)).collect()} == {"a": 4}
    m = spark.createDataFrame([("x", 10.0, 1.0, 6, 6), ("y", 11.0, 1.0, 6, 6), ("z", 1.0, 10.0, 6, 6),
                               ("w", 1.0, 11.0, 6, 6), ("q", 5.0, 0.0, 6, 6)],
                              "id string, sent_volume double, received_volume double, transactions_sent long, "
                              "transactions_received long")
    assert [r.id for r in A.volume_ratio_high(m).collect()] == ["y"]          # exactly 10 is not above
    assert sorted(r.id for r in A.volume_ratio_low(m).collect()) == ["w"]     # exactly 0.1 is not below


def test_metrics_fill_and_kmeans_gate(spark):
    t = _trades(spark, [("a", "b"), ("b", "c")])
    v, e, ranks, m = A.graph_metrics(t)
    rows = {r.id: r for r in m.collect()}
    assert rows["a"].inDegree == 0 and rows["a"].received_volume == 0.0 and rows["c"].outDegree == 0
    clustered, centers = A.kmeans_clusters(m)
    assert clustered is None and centers == []                                 # fewer than 20 addresses


def test_kmeans_is_a_function_of_the_table(spark):
    rng = np.random.default_rng(1)
    centre = np.repeat([0.0, 50.0, 200.0], [60, 40, 5])
    rows = [(f"a{i:03d}", *[float(c + x) for x in rng.normal(size=7)]) for i, c in enumerate(centre)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"{c} double" for c in A.METRIC_FEATURES))
    got = [A.kmeans_clusters(d, max_k=4) for d in (df, df.repartition(7).orderBy(F.rand(3)))]
    one, two = ({r.id: (r.prediction, round(r.distance_to_centroid, 6)) for r in c.collect()} for c, _ in got)
    assert one == two and np.allclose(got[0][1], got[1][1], atol=1e-8) and len(one) == 105
    # the fixed point of the rounds: every centre is the mean of its members
    z = {r["id"]: r["scaled"] for r in got[0][0].collect()}
    for k, c in enumerate(got[0][1]):
        mine = [z[i] for i, (p, _) in one.items() if p == k]
        assert not mine or np.allclose(np.mean(mine, axis=0), c, atol=1e-6)


def test_components_split_a_hub(spark):
    # a hub with most of the edges, under a threshold that calls it skewed
    sizes = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    keep = {k: spark.conf.get(k, None) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        pairs = spark.range(60_000).select(F.lit("hub").alias("a"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("b")) \
            .union(spark.range(500).select(F.concat(F.lit("w"), F.col("id").cast("string")), F.concat(F.lit("x"), F.col("id").cast("string"))))
        star = G._large_star(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).repartition(8))
        assert star.count() > 0
        star.collect()
        plan = star._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pagerank_rounds_leave_the_edges_where_they_lie(spark, monkeypatch):
    edges = spark.createDataFrame([(f"a{i % 7}", f"a{i}") for i in range(50)], "src string, dst string")
    ids = spark.createDataFrame([(f"a{i}",) for i in range(50)], "id string")
    names = []
    real = G.stored
    monkeypatch.setattr(G, "stored", lambda df, name: names.append(name) or real(df, name))
    ranks = G.pagerank(ids, edges, iterations=5)
    # ranks that are read back each round have no partitioning that the edges would have to follow
    assert names.count("pagerank-ranks") == 5 and ranks.count() == 50
    laid = G._laid_out(edges, 16, "src")
    assert sorted(laid.collect()) == sorted(edges.collect()) and laid.rdd.getNumPartitions() == 16
    laid.unpersist()
    assert spark.conf.get(G._FREE_CACHE, "true") == "true"


def test_rounds_choose_the_centres_that_the_assignment_chooses(spark):
    import pyarrow as pa
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 3)), 1)                       # ties between centres
    centers = [[0.5, 0.0, -0.5], [0.5, 0.0, 0.5], [-1.0, 1.0, 0.0], [0.5, 0.0, -0.5]]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, scaled array<double>")
    want = {r.id: (r.prediction, r.distance_to_centroid) for r in A._nearest(df, centers).collect()}
    xs = ["x0", "x1", "x2"]
    got = A._assigned(df.withColumns({c: F.col("scaled")[k] for k, c in enumerate(xs)}), centers, xs).collect()
    assert {r.id: (r.prediction, r.distance_to_centroid) for r in got} == want and len(got) == 400
    odd = spark.createDataFrame([(0, None, 0.0, 0.0), (1, float("nan"), 0.0, 0.0), (2, 0.5, 0.0, 0.5)], "id long, x0 double, x1 double, x2 double")
    got = A._assigned(odd, centers, xs).orderBy("id").collect()
    assert [r.prediction for r in got] == [0, 0, 1] and got[0].distance_to_centroid is None and np.isnan(got[1].distance_to_centroid)


def test_a_round_reads_the_features_alone(spark, monkeypatch):
    # before, every round made the z-scores of all columns again
    rows = [(f"a{i:03d}", "text", *[float((i * k) % 17) for k in range(1, 8)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, symbol string, " + ", ".join(f"{c} double" for c in A.METRIC_FEATURES))
    written = {}
    real = A.stored
    monkeypatch.setattr(A, "stored", lambda d, name: written.setdefault(name, real(d, name)))
    A.kmeans_clusters(df)
    assert written["cluster-features"].columns == [f"x{i}" for i in range(7)]


def test_metrics_of_repeated_and_unknown_ids(spark):
    t = _trades(spark, [("a", "b"), ("b", "c"), (None, "c")])
    v, e = G.build_vertices(t), G.build_edges(t)
    ranks = spark.createDataFrame([("a", 1.0), ("q", 2.0)], "id string, pagerank double")
    m = {r.id: r for r in A.address_metrics(v.union(v).where("id != 'c'"), e, t, ranks).collect()}
    assert sorted(m) == ["a", "b"] and m["a"].pagerank == 1.0 and m["b"].pagerank == 0.0
    assert m["b"].inDegree == 1 and m["b"].outDegree == 1 and m["a"].symbol == "S" and m["a"].transactions_sent == 1


@pytest.mark.parametrize("hot", [1 << 16, 2])
def test_pagerank_counts_repeated_edges(spark, hot):
    pairs = [("a", "b")] * 5 + [("a", "c"), ("b", "a"), ("c", "c"), ("c", "b"), ("c", "b")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    want = _numpy_pagerank(["a", "b", "c", "d"], pairs)
    got = {r.id: r.pagerank for r in G.pagerank(ids, edges, hot_degree=hot).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_pagerank_rounds_sort_sources_and_not_edges(spark, monkeypatch):
    edges = spark.createDataFrame([(f"a{i % 7}", f"a{i}") for i in range(50)], "src string, dst string")
    ids = spark.createDataFrame([(f"a{i}",) for i in range(50)], "id string")
    laid = []
    real = G._laid_out
    monkeypatch.setattr(G, "_laid_out", lambda df, n, *keys, **kw: laid.append((real(df, n, *keys, **kw), keys)) or laid[-1][0])
    G.pagerank(ids, edges, iterations=2)
    assert laid[0][1] == ("src",) and laid[0][0].count() == 7       # before, one row for every edge
