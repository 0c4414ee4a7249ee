import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.streaming import jobs as SJ
from tests.conftest import SF001


def _write(spark, folder, name, rows):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), 1, "click", 1.0, "{}")
                                for i, m in rows], SJ.EVENTS_SCHEMA)
    df.coalesce(1).write.parquet(os.path.join(folder, name))


def test_late_row_dropped_after_watermark_passes(spark):
    root = tempfile.mkdtemp(prefix="ll-late-")
    src = os.path.join(root, "src")
    # one file per micro-batch: three advance the watermark, the last is late.
    # A batch filters late rows with the watermark of the batch before it, so
    # a row is dropped only once the watermark has passed it for two batches.
    _write(spark, src, "f1", [(1, 10), (2, 20)])
    _write(spark, src, "f2", [(3, 150)])
    _write(spark, src, "f3", [(4, 160)])
    _write(spark, src, "f4", [(5, 30)])
    stream = (spark.readStream.schema(SJ.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src)
              .withColumn("ts", F.col("ts").cast("timestamp")))
    w = SJ.stream_windows(stream, "ts", "1 hour", "0 seconds")
    out = SJ.run_available_now(w, "late", sink_path=os.path.join(root, "sink")).collect()
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert [(r.window_start - base, r.n) for r in out] == [(0, 2)]      # 02:00 window still open


def test_stream_windows_over_events_close_by_watermark(spark):
    from tests.conftest import SF001
    ev = SJ.event_stream(spark, SF001).withColumn("ts", F.col("ts").cast("timestamp"))
    out = SJ.run_available_now(SJ.stream_windows(ev, "ts", "1 day", "0 seconds"), "ev")
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    mx = batch.agg(F.max(F.unix_seconds(F.col("ts").cast("timestamp")))).first()[0]
    want = (batch.withColumn("ws", F.unix_seconds(F.col("ts").cast("timestamp")))
            .withColumn("ws", F.col("ws") - F.pmod("ws", F.lit(86400)))
            .where(F.col("ws") + 86400 <= mx).groupBy("ws").count())
    assert sorted((r.window_start, r.n) for r in out.collect()) == sorted(tuple(r) for r in want.collect())


def test_a_sink_that_cannot_be_read_raises(spark, tmp_path):
    import pytest
    schema = SJ.EVENTS_SCHEMA
    assert SJ._read_sink(spark, str(tmp_path / "never"), schema).count() == 0
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        SJ._read_sink(spark, str(tmp_path / "data"), schema).count()


def test_stream_dedup_keeps_null_hash_trades_of_different_seconds(spark, tmp_path):
    import json
    def trade(hash_, t):
        return {"protocol": "p", "block": {"timestamp": {"time": None, "unixtime": t}, "height": 1},
                "transaction": {"hash": hash_}, "buyCurrency": {"symbol": "a", "address": "x"}, "buyAmount": 1.0,
                "sellCurrency": {"symbol": "b", "address": "y"}, "sellAmount": 2.0, "trades": 1, "gasValue": 0.1, "gasPrice": 1.0}
    rows = [trade(None, 1000), trade(None, 1001), trade(None, 1001), trade("h", 1000), trade("h", 1000)]
    gone = trade("z", 1002) | {"transaction": None}
    late = trade("late", 9000)
    (tmp_path / "m").mkdir()
    for i, part in enumerate((rows + [gone], [late])):
        (tmp_path / "m" / f"{i}.json").write_text(json.dumps({"data": {"ethereum": {"dexTrades": part}}}) + "\n")
    stream = SJ.message_stream(spark, str(tmp_path / "m"), max_files_per_trigger=1)
    out = SJ.run_available_now(SJ.stream_dedup(SJ.stream_features(stream)), "nulls").collect()
    assert sorted(r["unique_id"] for r in out if r["tx_hash"] != "late") == ["None_1000", "None_1001", "h_1000"]


def test_messages_are_encoded_once_and_land_twice(spark, monkeypatch):
    from ledgerlens.plans import q_stream as QS
    calls, real = [], QS.M.encode_messages
    monkeypatch.setattr(QS.M, "encode_messages", lambda *a, **k: calls.append(1) or real(*a, **k))
    landed, write = [], QS._write_messages
    monkeypatch.setattr(QS, "_write_messages", lambda m, path: landed.append(path) or write(m, path))
    out = QS.q_stream_dedup_across(spark, SF001)
    assert len(calls) == 1 and len(landed) == 2                  # before, the second landing was encoded again
    a, b = (sorted(r.value for r in spark.read.text(p).collect()) for p in landed)
    assert a == b and len(a) > 1000
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey").distinct().count()
    assert out.count() == n == out.distinct().count()


def test_state_lies_on_disk_unless_the_submitter_names_a_store(spark):
    key, before = SJ._PROVIDER, spark.conf.get(SJ._PROVIDER)
    try:
        SJ.state_on_disk(spark)
        assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")       # before, all open keys lay in the heap
        with tempfile.TemporaryDirectory() as d:
            _write(spark, d, "a.parquet", [(i % 5, i % 3) for i in range(30)] + [(99, 10)])
            ev = SJ.event_stream(spark, d, glob="*.parquet", recursive=True).withColumn("ts", F.col("ts").cast("timestamp"))
            one = SJ.stream_dedup(ev, "1 minute", time_col="ts", key="event_id")
            out = SJ.run_available_now(one, "state", sink_path=d + "/out")
            assert out.select("window_start", "event_id").distinct().count() == out.count() == 15
    finally:
        spark.conf.set(key, before)
