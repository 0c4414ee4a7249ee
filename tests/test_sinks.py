import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.operators import graph as G
from ledgerlens.plans import batch_rules
from ledgerlens.sources import messages as M
from ledgerlens.sources import sinks as SK
from ledgerlens.sources.tables import trades
from tests.conftest import SF001


def test_save_results_stamps_conforms_and_skips_empty(spark):
    base = tempfile.mkdtemp(prefix="ll-sink-")
    t = trades(spark, SF001)
    v = G.build_vertices(t)
    written = SK.save_results({"graph_vertices": v, "graph_edges": G.build_edges(t), "token_pairs": G.token_pairs(t, 5),
                               "volume_ratio_high_anomalous_addresses": v.limit(0)}, base, "2024-01-01 00:00:00")
    assert list(written) == ["graph_vertices", "graph_edges", "token_pairs"]
    assert written["graph_vertices"] == v.count() and not os.path.exists(os.path.join(base, "volume_ratio_high_anomalous_addresses"))
    ge = spark.read.parquet(os.path.join(base, "graph_edges"))
    assert dict(ge.dtypes)["latest_timestamp"] == "timestamp" and ge.where(F.col("latest_timestamp").isNull()).count() == 0
    gv = spark.read.parquet(os.path.join(base, "graph_vertices"))
    assert gv.columns[-1] == "analysis_timestamp" and gv.count() == v.count()
    # a second run appends; the latest-run reader returns one run only
    SK.save_results({"graph_vertices": v}, base, "2024-01-01 01:00:00")
    again = spark.read.parquet(os.path.join(base, "graph_vertices"))
    assert again.count() == 2 * v.count() and SK.latest_snapshot(again).count() == v.count()


def test_mark_analyzed_row_preserving(spark):
    t = trades(spark, SF001)
    processed = t.where(~F.col("analyzed")).limit(50)
    marked = SK.mark_analyzed(t, processed)
    assert marked.count() == t.count()
    hashes = [r.tx_hash for r in processed.select("tx_hash").distinct().collect()]
    assert marked.where(F.col("tx_hash").isin(hashes) & ~F.col("analyzed")).count() == 0
    assert marked.where(F.col("analyzed")).count() >= t.where(F.col("analyzed")).count()


def test_batch_job_with_history_from_its_own_sink(spark):
    base = tempfile.mkdtemp(prefix="ll-batch-")
    raw = M.encode_messages(trades(spark, SF001))
    first = batch_rules.batch_score(raw)
    batch_rules.append_scored(first, os.path.join(base, "scored"))
    hist = spark.read.parquet(os.path.join(base, "scored"))
    again = batch_rules.batch_score(raw, history=hist)
    # re-running a batch against a history that already holds it counts each trade twice (kept behaviour)
    a = {(r.transaction.hash, r.buyCurrency.address, r.block.timestamp.unixtime): r.transactions_in_window
         for r in first.collect()}
    b = {(r.transaction.hash, r.buyCurrency.address, r.block.timestamp.unixtime): r.transactions_in_window
         for r in again.collect()}
    assert a.keys() == b.keys() and all(b[k] >= 2 * a[k] - 0 for k in a if a[k] == 1)
    assert again.count() == first.count()
    # without its own rows in the history a rerun counts as the first run did
    rerun = batch_rules.batch_score(raw, history=hist, skip_reprocessed=True)
    c = {(r.transaction.hash, r.buyCurrency.address, r.block.timestamp.unixtime): r.transactions_in_window for r in rerun.collect()}
    assert c == a


def test_graph_job_end_to_end(spark):
    from ledgerlens.plans import graph_job
    base = tempfile.mkdtemp(prefix="ll-graph-")
    t = trades(spark, SF001)
    out = graph_job.run_graph_job(t, os.path.join(base, "results"), os.path.join(base, "trades_v2"),
                                  "2001-07-31 00:00:00")
    assert {"graph_vertices", "graph_edges", "important_addresses", "token_pairs",
            "graph_based_anomalous_addresses"} <= set(out["written"])
    snap = spark.read.parquet(out["snapshot"])
    assert snap.count() == t.count()
    loaded = t.where(~F.col("analyzed") & (F.col("detection_time") < F.lit("2001-07-30 22:30:00").cast("timestamp")))
    hashes = loaded.select("tx_hash").distinct()
    assert snap.join(hashes, "tx_hash", "left_semi").where(~F.col("analyzed")).count() == 0


def test_ensure_table_creates_once_with_comments(spark, tmp_path):
    assert SK.ensure_table(spark, "graph_vertices", str(tmp_path))
    assert not SK.ensure_table(spark, "graph_vertices", str(tmp_path))
    stored = spark.read.parquet(str(tmp_path / "graph_vertices"))
    assert stored.count() == 0 and stored.columns == [f.name for f in SK.described_schema("graph_vertices").fields]
    assert all(f.metadata.get("comment") for f in stored.schema.fields)
    v = G.build_vertices(trades(spark, SF001))
    SK.save_results({"graph_vertices": v}, str(tmp_path), "2024-01-01 00:00:00")
    assert spark.read.parquet(str(tmp_path / "graph_vertices")).count() == v.count()


def test_history_scan_prunes_folders_of_the_scored_table(spark, tmp_path):
    from ledgerlens.operators import rules as R
    path = str(tmp_path / "scored")
    t = trades(spark, SF001)
    batch_rules.append_scored(batch_rules.batch_score(M.encode_messages(t)), path)
    hi = t.agg(F.max("block_unixtime")).first()[0]
    kept = R.history_scan(spark.read.parquet(path), hi - 86400, hi)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_date" in plan and "block.timestamp.unixtime" in plan


def test_update_analyzed_rewrites_only_what_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(f"h{i}", i % 4, i % 3 == 0) for i in range(40)], "tx_hash string, day int, analyzed boolean") \
        .write.partitionBy("day").parquet(path)
    files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in sorted(os.listdir(path)) if d.startswith("day=")}
    before = files()
    done = spark.createDataFrame([("h1",), ("h5",), ("h5",), ("h0",), (None,)], "tx_hash string")
    assert SK.update_analyzed(spark, path, done, "day") == 2          # h0 is flagged already
    after = files()
    assert [d for d in before if before[d] != after[d]] == ["day=1"]
    got = {r.tx_hash: r.analyzed for r in spark.read.parquet(path).collect()}
    assert len(got) == 40 and all(v == (k in ("h1", "h5") or int(k[1:]) % 3 == 0) for k, v in got.items())
    assert SK.update_analyzed(spark, path, done, "day") == 0 and files() == after
