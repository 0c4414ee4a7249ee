"""Registered queries of the streaming family and the isolation forest.

Stream keys run a real Structured Streaming query (``availableNow``) over a
source derived from the driver tables: trade messages encoded from the
trades view and landed as text in the shared checkpoint folder, or the
``events`` parquet read as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import iforest as IF
from ..session import scratch_path, stored
from ..sources import messages as M
from ..sources.tables import read_table, trades
from ..streaming import jobs as SJ
from . import q_features as QF
from . import sql_forest, stream_scorer
from .registry import ORACLES, register

WINDOW = "1 day"


def land_messages(spark, sf):
    """Encode the trades view as messages and land them as a text folder."""
    path = scratch_path(spark, "landing")
    _land(spark, sf, path)
    return path


def _land(spark, sf, path):
    _write_messages(M.encode_messages(trades(spark, sf)).select("value"), path)


def _write_messages(messages, path):
    # JSON repeats its names in every message: a landing is kept compressed, at a level of half the default's time
    messages.write.option("zlib.compress.level", "THREE").text(path, compression="gzip")


def _message_stream(spark, sf):
    return SJ.message_stream(spark, land_messages(spark, sf))


@register("stream_parse", """
SELECT protocol, block_unixtime, block_height, tx_hash, buy_currency, buy_address,
       round(buy_amount, 4) AS buy_amount, sell_currency, sell_address, round(sell_amount, 4) AS sell_amount,
       gas_value, gas_price FROM trades""")
def q_stream_parse(spark, sf):
    flat = M.flatten_trades(_message_stream(spark, sf))
    out = SJ.run_available_now(flat, "stream_parse")
    return out.select("protocol", "block_unixtime", "block_height", "tx_hash", "buy_currency", "buy_address",
                      F.round("buy_amount", 4).alias("buy_amount"), "sell_currency", "sell_address",
                      F.round("sell_amount", 4).alias("sell_amount"), "gas_value", "gas_price")


@register("stream_features", ORACLES["extract_features"], trades_cte=False)
def q_stream_features(spark, sf):
    out = SJ.run_available_now(SJ.stream_features(_message_stream(spark, sf)), "stream_features")
    return out.select("tx_hash", "block_unixtime", "buy_address",
                      *[F.round(c, 6).alias(c) for c in ("trade_ratio", "gas_cost_relative",
                                                          "time_of_day_sin", "time_of_day_cos")],
                      "unique_id", "analyzed")


@register("stream_windows", """
WITH h AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start, event_type, value FROM events),
mx AS (SELECT epoch(max(ts)) AS m FROM events)
SELECT window_start, event_type, count(*) AS n, round(sum(value), 4) AS total_value
FROM h WHERE window_start + 3600 <= (SELECT m FROM mx)
GROUP BY window_start, event_type""", trades_cte=False)
def q_stream_windows(spark, sf):
    ev = SJ.event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    w = SJ.stream_windows(ev, "ts", "1 hour", "0 seconds", keys=("event_type",),
                          aggs=[F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value")])
    out = SJ.run_available_now(w, "stream_windows")
    return out.select("window_start", "event_type", "n", F.round("total_value", 4).alias("total_value"))


def _event_windows(stream):
    ev = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return SJ.stream_windows(ev, "ts", "1 hour", "0 seconds", keys=("event_type",),
                             aggs=[F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value")])


@register("stream_late_drop", ORACLES["stream_windows"], trades_cte=False)
def q_stream_late_drop(spark, sf):
    """Events land in three time-ordered slices, then the first slice is
    replayed. The same streaming query (one checkpoint) runs after each
    landing; by the replay the watermark has passed every replayed row, so
    they are dropped and the closed windows equal those of one clean pass."""
    ev = read_table(spark, sf, "events")
    u = F.unix_seconds(F.col("ts").cast("timestamp"))
    b = ev.agg(F.min(u).alias("lo"), F.max(u).alias("hi")).first()
    cuts = [b["lo"] + (b["hi"] - b["lo"] + 1) * i // 3 for i in range(4)]
    slices = [(cuts[i], cuts[i + 1]) for i in range(3)] + [(cuts[0], cuts[1])]
    landing, sink = scratch_path(spark, "events_landing"), scratch_path(spark, "late_drop")
    out = None
    for i, (lo, hi) in enumerate(slices):
        ev.where((u >= lo) & (u < hi)).write.parquet(f"{landing}/arrival={i}")
        stream = SJ.event_stream(spark, landing, glob="*.parquet", recursive=True)
        out = SJ.run_available_now(_event_windows(stream), "late_drop", sink_path=sink)
    return out.select("window_start", "event_type", "n", F.round("total_value", 4).alias("total_value"))


@register("stream_dedup", QF._FEATURES_SQL.join(["WITH f AS (", ""]) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start, unique_id
        ORDER BY protocol NULLS FIRST, block_unixtime NULLS FIRST, block_height NULLS FIRST, tx_hash NULLS FIRST,
                 buy_currency NULLS FIRST, buy_address NULLS FIRST, buy_amount NULLS FIRST,
                 sell_currency NULLS FIRST, sell_address NULLS FIRST, sell_amount NULLS FIRST) AS rn FROM f)
SELECT window_start, unique_id, tx_hash, buy_address, sell_address, round(buy_amount, 4) AS buy_amount,
       round(sell_amount, 4) AS sell_amount
FROM r WHERE rn = 1 AND window_start + 86400 <= (SELECT max(block_unixtime) FROM trades)""")
def q_stream_dedup(spark, sf):
    # the columns of its order: what follows them never decides, and none of it is returned
    rows = SJ.stream_features(_message_stream(spark, sf)).select(
        "unique_id", "block_timestamp", "protocol", "block_unixtime", "block_height", "tx_hash", "buy_currency", "buy_address",
        "buy_amount", "sell_currency", "sell_address", "sell_amount")
    d = SJ.stream_dedup(rows, WINDOW)
    out = SJ.run_available_now(d.select("window_start", "unique_id", "tx_hash", "buy_address", "sell_address", "buy_amount",
                                        "sell_amount"), "stream_dedup")
    return out.select("window_start", "unique_id", "tx_hash", "buy_address", "sell_address",
                      F.round("buy_amount", 4).alias("buy_amount"), F.round("sell_amount", 4).alias("sell_amount"))


@register("stream_dedup_across", """SELECT DISTINCT tx_hash FROM trades""")
def q_stream_dedup_across(spark, sf):
    """One trade per transaction, across windows: the messages land, and the
    messages that landed land again; the same streaming query runs after each
    landing and the second one adds nothing."""
    landing, sink = scratch_path(spark, "dedup_landing"), scratch_path(spark, "dedup_across")
    out = None
    for i in range(2):
        if i == 0:
            _land(spark, sf, f"{landing}/arrival=0")
        else:
            _write_messages(M.read_json_messages(spark, f"{landing}/arrival=0"), f"{landing}/arrival={i}")
        raw = spark.readStream.format("text").option("recursiveFileLookup", "true").load(landing)
        # a streaming dedup carries every column it is given through its shuffle
        kept = SJ.stream_dedup_across(SJ.stream_features(raw).select("tx_hash", "block_timestamp"), hold="20000 days")
        out = SJ.run_available_now(kept.select("tx_hash"), "dedup_across", sink_path=sink)
    return out


def _forest_input(spark, sf):
    """Features, one row per (1-day window, trade id), standardised."""
    d = stored(FT.deduped_features(trades(spark, sf), WINDOW).select("window_start", "unique_id", *FT.X.STREAM_FEATURES), "forest-rows")
    z, cols = stream_scorer.forest_features(FT.window_zscore(d))
    return z.select("unique_id", "window_start", *cols), cols


_DEDUPED = QF._FEATURES_SQL.join(["WITH f0 AS (", ""]) + """),
f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY window_start, unique_id
        ORDER BY protocol NULLS FIRST, block_unixtime NULLS FIRST, block_height NULLS FIRST, tx_hash NULLS FIRST,
                 buy_currency NULLS FIRST, buy_address NULLS FIRST, buy_amount NULLS FIRST,
                 sell_currency NULLS FIRST, sell_address NULLS FIRST, sell_amount NULLS FIRST) AS rn FROM f0) WHERE rn = 1)"""
_Z_DEDUPED = QF._Z_SQL.split(",\nc AS", 1)[1]
_ROUNDED = ", ".join(f"round(z_{c}, 9) AS f_{c}" for c in FT.X.STREAM_FEATURES)
_FEATURE_COLS = ["f_" + c for c in FT.X.STREAM_FEATURES]


def _scored_sql(least_rows: int = 1, closed: bool = False) -> str:
    """Standardised rows ``z`` and their forest ``iso`` over the deduplicated
    trades; windows under ``least_rows`` have no forest."""
    kept = f"SELECT * FROM f0d WHERE cnt >= {least_rows}"
    if closed:
        kept += " AND window_start + 86400 <= (SELECT max(block_unixtime) FROM trades)"
    deduped = _DEDUPED.replace("\nf AS (", "\nfd AS (")
    return (deduped + ",\nf0d AS (SELECT *, count(*) OVER (PARTITION BY window_start) AS cnt FROM fd),\nf AS (" + kept + "),\nc AS"
            + _Z_DEDUPED + f",\nzr AS (SELECT unique_id, window_start, {_ROUNDED} FROM z),"
            + sql_forest.forest_sql("zr", _FEATURE_COLS))


_REASON = ORACLES["anomaly_reason"].split("SELECT tx_hash, block_unixtime, buy_address,", 1)[1].split(" AS reason", 1)[0]


def _trades_table_sql(closed: bool = False) -> str:
    open_end = " WHERE window_start + 86400 <= (SELECT max(block_unixtime) FROM trades)" if closed else ""
    return _scored_sql(stream_scorer.MIN_WINDOW_ROWS, closed) + f""",
p AS (SELECT z.*, {QF._PRIMARY} AS pf, iso.is_anomaly, iso.decision FROM z JOIN iso USING (unique_id, window_start)),
reasons AS (SELECT unique_id, window_start, round(decision, 6) + 0.0 AS anomaly_score, {_REASON} AS reason FROM p)
SELECT fd.protocol, fd.block_unixtime, fd.block_height, fd.tx_hash, fd.buy_currency, fd.buy_address,
       round(fd.buy_amount, 4) AS buy_amount, fd.sell_currency, fd.sell_address, round(fd.sell_amount, 4) AS sell_amount,
       round(fd.trade_ratio, 6) AS trade_ratio, coalesce(r.anomaly_score, 0.0) AS anomaly_score,
       coalesce(r.reason, 'Insufficient data for analysis') AS reason, false AS analyzed
FROM fd LEFT JOIN reasons r USING (unique_id, window_start){open_end}"""


def _table_columns(df):
    return df.select("protocol", "block_unixtime", "block_height", "tx_hash", "buy_currency", "buy_address",
                     F.round("buy_amount", 4).alias("buy_amount"), "sell_currency", "sell_address",
                     F.round("sell_amount", 4).alias("sell_amount"), F.round("trade_ratio", 6).alias("trade_ratio"),
                     (F.round("anomaly_score", 6) + F.lit(0.0)).alias("anomaly_score"), "reason", "analyzed")


@register("stream_scored", _trades_table_sql(closed=True))
def q_stream_scored(spark, sf):
    """End-to-end streaming scorer: the closed windows in the trades-table layout."""
    return _table_columns(SJ.score_stream(_message_stream(spark, sf), WINDOW))


@register("isolation_forest", _scored_sql() + """
SELECT unique_id, window_start, round(iso_score, 6) AS iso_score, round(decision, 6) + 0.0 AS decision, is_anomaly FROM iso""")
def q_isolation_forest(spark, sf):
    """Batch form: features -> dedup per 1-day window -> z-scores -> forest
    per window."""
    z, cols = _forest_input(spark, sf)
    s = IF.isolation_forest(z, cols, uid="unique_id", repeatable=True)
    return s.select("unique_id", "window_start", F.round("iso_score", 6).alias("iso_score"),
                    (F.round("decision", 6) + F.lit(0.0)).alias("decision"), "is_anomaly")


@register("score_windows", _trades_table_sql())
def q_score_windows(spark, sf):
    """Batch window scorer over the whole trades view: gate + forest +
    reason, in the trades-table layout."""
    d = FT.deduped_features(trades(spark, sf), WINDOW)
    return _table_columns(stream_scorer.to_trades_table(stream_scorer.score_windows(d)))


@register("window_anomaly_counts", _scored_sql() + """
SELECT window_start, count(*) AS window_rows, count(*) FILTER (is_anomaly) AS anomalies,
       round(min(decision), 6) + 0.0 AS lowest FROM iso GROUP BY window_start""")
def q_window_anomaly_counts(spark, sf):
    """Rows, anomalies and lowest decision per window. The forest runs in its
    split plan wherever a window has more than 16 rows."""
    z, cols = _forest_input(spark, sf)
    s = IF.isolation_forest(z, cols, uid="unique_id", chunk_rows=16, repeatable=True)
    s = stored(s.select("window_start", "decision", "is_anomaly"), "forest-decided")
    lowest = s.groupBy("window_start").agg((F.round(F.min("decision"), 6) + F.lit(0.0)).alias("lowest"))
    return IF.anomaly_counts(s).join(lowest, "window_start").select("window_start", "window_rows", "anomalies", "lowest")


@register("score_windows_outcome", _scored_sql(stream_scorer.MIN_WINDOW_ROWS) + """
SELECT fd.unique_id, fd.window_start, iso.unique_id IS NULL AS insufficient, coalesce(iso.is_anomaly, false) AS anomalous
FROM fd LEFT JOIN iso USING (unique_id, window_start)""")
def q_score_windows_outcome(spark, sf):
    """Gate and outcome of every scored trade, read from its score and reason:
    gated ones score 0 with the fixed reason, anomalous ones have a reason of
    their own and a score below 0."""
    d = FT.deduped_features(trades(spark, sf), WINDOW)
    s = stream_scorer.score_windows(d)
    gated = (F.col("reason") == FT.X.REASON_INSUFFICIENT) & (F.col("anomaly_score") == 0)
    anomalous = (F.col("reason") != FT.X.REASON_NO_ANOMALY) & (F.col("anomaly_score") < 0)
    return s.select("unique_id", "window_start", gated.alias("insufficient"), anomalous.alias("anomalous"))


_RAW = ["buy_amount", "sell_amount", "log_amount"]


@register("forest_errors", _DEDUPED + """,
bad AS (SELECT DISTINCT window_start FROM f WHERE buy_amount <= 0)
SELECT unique_id, f.window_start, bad.window_start IS NOT NULL AS failed,
       CASE WHEN bad.window_start IS NOT NULL THEN 0.0 END AS failed_score FROM f LEFT JOIN bad ON bad.window_start = f.window_start""")
def q_forest_errors(spark, sf):
    """The error path: on amounts that were not cleaned (the logarithm of an
    amount of 0 is missing) a window with such a trade fails and keeps all its
    trades with the error and decision 0; the others are scored. Windows of over
    24 rows are split, so both plans fail."""
    d = FT.deduped_features(trades(spark, sf), WINDOW)
    raw = d.withColumn("log_amount", F.when(F.col("buy_amount") > 0, F.log("buy_amount")))
    s = IF.isolation_forest(raw.select("unique_id", "window_start", *_RAW), _RAW, uid="unique_id", trees=10, chunk_rows=24)
    failed = F.col("error").isNotNull()
    return s.select("unique_id", "window_start", failed.alias("failed"), F.when(failed, F.col("decision")).alias("failed_score"))
