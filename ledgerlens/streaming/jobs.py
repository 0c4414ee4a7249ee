"""Structured Streaming jobs: message / event sources, feature extraction,
watermarked tumbling windows, in-window dedup and per-window scoring via
``foreachBatch``. Runs incrementally with a checkpoint; ``availableNow``
processes what has landed and stops (the hourly-batch replacement)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as FT
from ..plans import stream_scorer
from .. import schemas
from ..session import ensure_conf, path_exists, scratch_path
from ..sources import messages as M

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   glob: str | None = None) -> DataFrame:
    """Unbounded source of raw JSON messages (one per line) in a folder. A
    Kafka source (``value`` cast to string) plugs into the same code."""
    ensure_conf(spark)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def event_stream(spark: SparkSession, folder: str, glob: str | None = "events.parquet",
                 max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    ensure_conf(spark)
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(folder)


def stream_features(raw: DataFrame) -> DataFrame:
    """Decode + explode + flatten + features: stateless, per record."""
    return FT.extract_features(M.flatten_trades(raw))


def stream_windows(df: DataFrame, time_col: str, window: str = "60 seconds", delay: str = "0 seconds",
                   keys=(), aggs=None) -> DataFrame:
    """Tumbling windows on event time with a watermark; in append mode a
    window is emitted once, when the watermark passes its end; rows later
    than the watermark are dropped. ``window_start`` is epoch seconds."""
    aggs = aggs or [F.count(F.lit(1)).alias("n")]
    g = (df.withWatermark(time_col, delay)
         .groupBy(F.window(time_col, window).alias("w"), *keys).agg(*aggs))
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), *keys,
                    *[c for c in g.columns if c not in ("w", *keys)])


def stream_dedup(features: DataFrame, window: str = "60 seconds", delay: str = "0 seconds",
                 time_col: str = "block_timestamp", key: str = "unique_id") -> DataFrame:
    """One row per (window, key), the smallest by value; emitted when the
    window closes. State is kept per (window, key) until the watermark
    passes the window end."""
    others = [c for c in features.columns if c not in (key,)]
    g = (features.withWatermark(time_col, delay)
         .groupBy(F.window(time_col, window).alias("w"), key)
         .agg(F.min(F.struct(*others)).alias("_r")))
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), key,
                    *[F.col("_r." + c).alias(c) for c in others])


def stream_dedup_across(features: DataFrame, keys=("tx_hash",), hold: str = "1 hour",
                        time_col: str = "block_timestamp") -> DataFrame:
    """The first row to arrive of every key, across windows: a key stays in the
    state until the watermark, ``hold`` behind the latest time, has passed it, so
    repeats in adjacent windows and replayed messages go."""
    return features.withWatermark(time_col, hold).dropDuplicatesWithinWatermark(list(keys))


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb."
_STATE_CONF = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _ROCKSDB + "changelogCheckpointing.enabled": "true",
    _ROCKSDB + "trackTotalNumberOfRows": "false",
    _ROCKSDB + "boundedMemoryUsage": "true",
}


def state_on_disk(spark: SparkSession) -> None:
    """Dedup keeps a row of state for every key of its open windows: unless the
    submitter names a state store, it is RocksDB on the executors' local disks
    and not their heap. A query that resumes keeps the store of its checkpoint."""
    if not spark.sparkContext.getConf().contains(_PROVIDER):
        for k, v in _STATE_CONF.items():
            if not spark.sparkContext.getConf().contains(k):
                spark.conf.set(k, v)


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      sink_path: str | None = None, timeout_s: float | None = None) -> DataFrame:
    """Run a streaming frame to completion over the data available now into a
    Parquet sink under the shared checkpoint folder; return the sink read
    as a batch frame. The checkpoint makes a re-run resume, not redo."""
    spark = df.sparkSession
    state_on_disk(spark)
    out = sink_path or scratch_path(spark, name)
    q = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True).start())
    _finish(q, name, timeout_s)
    return _read_sink(spark, out + "/data", df.schema)


def _finish(q, name: str, timeout_s: float | None) -> None:
    """Wait for the query to end (without a limit unless one is given) and
    raise what ended it."""
    q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise q.exception()


def _read_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """The sink as a batch frame; a sink never written is empty, any other
    failure to read it is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def score_stream(raw: DataFrame, window: str = "60 seconds", delay: str = "0 seconds",
                 sink_path: str | None = None, timeout_s: float | None = None, **score_args) -> DataFrame:
    """The streaming scorer: messages -> features -> watermarked dedup per
    window -> ``foreachBatch`` scoring of the closed windows -> trades table
    (Parquet, one folder per epoch, so a replayed epoch overwrites itself)."""
    spark = raw.sparkSession
    state_on_disk(spark)
    out = sink_path or scratch_path(spark, "stream_scored")
    # the state holds base columns; what follows from them is computed behind it
    dedup = stream_dedup(stream_features(raw).drop(*FT.DERIVED), window, delay)

    def score_batch(batch: DataFrame, epoch: int) -> None:
        # the scorer writes the batch before it reads it again, so the stateful dedup runs once
        scored = stream_scorer.to_trades_table(stream_scorer.score_windows(FT.with_features(batch), **score_args))
        scored.write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")

    q = (dedup.writeStream.outputMode("append").foreachBatch(score_batch)
         .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    _finish(q, "stream_scored", timeout_s)
    return _read_sink(spark, out + "/data", schemas.FLAT_TRADE)
