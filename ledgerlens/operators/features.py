"""Per-trade features and per-window statistics of the stream scorer:
feature extraction, dedup inside a window, the minimum-size gate, window
standardisation and the anomaly reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..session import stored

REQUIRED = ("block_unixtime", "buy_amount", "sell_amount", "gas_value", "gas_price")


def extract_features(df: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """Flat base trade columns -> feature columns of the trades table.

    A trade missing its time, an amount or a gas field (absent, null or
    non-numeric text), or its whole transaction, is rejected: dropped, or with
    ``keep_rejects`` kept with ``rejected = true`` for a side table. A
    transaction without a hash is kept. Stateless: one projection."""
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    if "no_transaction" in df.columns:
        ok = ok & ~F.col("no_transaction")
    if "block_time_text" in df.columns:
        ts = F.coalesce(F.try_to_timestamp(F.col("block_time_text"), F.lit("yyyy-MM-dd HH:mm:ss")),
                        F.timestamp_seconds("block_unixtime"))
    else:
        ts = F.timestamp_seconds("block_unixtime")
    out = (with_features(df.withColumn("block_timestamp", ts))
           .withColumn("unique_id", X.unique_id("tx_hash", "block_unixtime"))
           .withColumn("analyzed", F.lit(False)))
    out = out.withColumn("rejected", ~ok) if keep_rejects else out.where(ok)
    return out.drop("no_transaction")


DERIVED = ("trade_ratio", "gas_cost_relative", "time_of_day_sin", "time_of_day_cos")


def with_features(df: DataFrame) -> DataFrame:
    """Adds the ``DERIVED`` columns, functions of a trade's own base columns: a
    dedup leaves them out and they are computed again behind it."""
    return (df.withColumn("trade_ratio", X.safe_ratio("sell_amount", "buy_amount"))
            .withColumn("gas_cost_relative", X.safe_ratio("gas_value", "buy_amount"))
            .withColumn("time_of_day_sin", X.time_of_day_sin("block_unixtime"))
            .withColumn("time_of_day_cos", X.time_of_day_cos("block_unixtime")))


def deduped_features(df: DataFrame, window="60 seconds") -> DataFrame:
    """``extract_features`` of the trades, one row per (window, trade id). The
    derived columns follow from the base ones, which come before them in a row's
    order: the smallest row is the same without them."""
    return with_features(window_dedup(extract_features(df).drop(*DERIVED), window))


def with_window(df: DataFrame, window="60 seconds", time_col: str = "block_unixtime") -> DataFrame:
    """Adds ``window_start`` (epoch seconds) of the tumbling window."""
    return df.withColumn("window_start", X.epoch_window_start(time_col, X.parse_duration(window)))


def window_dedup(df: DataFrame, window="60 seconds", time_col: str = "block_unixtime",
                 keys=("unique_id",)) -> DataFrame:
    """One row per (window, key): the smallest row by its column values
    (deterministic, unlike "first seen").

    ``groupBy(window_start, key).agg(min(struct(...)))`` is a declarative
    aggregate with map-side partial aggregation, so a key repeated a million
    times shuffles one row per map task, not a million."""
    w = df if "window_start" in df.columns else with_window(df, window, time_col)
    others = [c for c in w.columns if c not in ("window_start", *keys)]
    agg = w.groupBy("window_start", *keys).agg(F.min(F.struct(*others)).alias("_r"))
    return agg.select("window_start", *keys, *[F.col("_r." + c).alias(c) for c in others])


def window_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("window_start").agg(F.count(F.lit(1)).alias("window_rows"))


def read_back(small: DataFrame, name: str) -> DataFrame:
    """A table of few rows per window before its join: written, so that the
    planner knows its size. A stream is left as it is."""
    return small if small.isStreaming else stored(small, name)


def window_gate(df: DataFrame, window="60 seconds", time_col: str = "block_unixtime",
                min_rows: int = 10) -> DataFrame:
    """Adds ``window_rows`` and ``gated`` (window has fewer than ``min_rows``
    trades, so it is not scored: score 0.0, reason "Insufficient data for
    analysis").

    Counting is a partial aggregation, read back and joined on the window key
    (the planner broadcasts the count table when its size allows, and no row is
    dealt out); a hot window is never gathered into one task."""
    w = df if "window_start" in df.columns else with_window(df, window, time_col)
    out = w.join(read_back(window_counts(w), "window-counts"), "window_start")
    gated = F.col("window_rows") < F.lit(min_rows)
    return (out.withColumn("gated", gated)
            .withColumn("anomaly_score", F.when(gated, F.lit(0.0)))
            .withColumn("reason", F.when(gated, F.lit(X.REASON_INSUFFICIENT))))


def window_zscore(df: DataFrame, window="60 seconds", time_col: str = "block_unixtime",
                  cols=tuple(X.STREAM_FEATURES), prefix: str = "z_") -> DataFrame:
    """Per-window standardisation: ``(x - mean) / std`` with population std;
    a zero std divides by 1. Features are first cleaned (NaN -> 0,
    +/-inf -> +/-1e10). Adds ``x_<col>`` (clean value) and ``z_<col>``.

    Mean and std are one aggregation per window (partial aggregation), read back
    and joined on the window key."""
    w = df if "window_start" in df.columns else with_window(df, window, time_col)
    for c in cols:
        w = w.withColumn("x_" + c, X.nan_to_num(c))
    stats = w.groupBy("window_start").agg(
        *[F.avg("x_" + c).alias("_m_" + c) for c in cols],
        *[F.stddev_pop("x_" + c).alias("_s_" + c) for c in cols])
    out = w.join(read_back(stats, "window-stats"), "window_start")
    for c in cols:
        sd = F.col("_s_" + c)
        out = out.withColumn(prefix + c, (F.col("x_" + c) - F.col("_m_" + c))
                             / F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def anomaly_reason(df: DataFrame, is_anomaly, cols=tuple(X.STREAM_FEATURES), z_prefix: str = "z_",
                   x_prefix: str = "x_") -> DataFrame:
    """Adds ``primary_factor`` and ``reason``.

    The primary factor is the feature with the largest absolute z (the first
    one wins a tie); amounts read "Unusually large/small <feature>" by the sign
    of the cleaned value; a row that is not anomalous reads "No anomaly
    detected"."""
    is_anomaly = X.col_(is_anomaly)
    absz = [F.abs(F.col(z_prefix + c)) for c in cols]
    top = F.greatest(*absz)
    primary = None
    for c, a in zip(cols, absz):
        primary = F.when(a == top, F.lit(c)) if primary is None else primary.when(a == top, F.lit(c))
    df = df.withColumn("primary_factor", primary)
    pf = F.col("primary_factor")
    raw = None
    for c in ("buy_amount", "sell_amount"):
        branch = F.when(F.col(x_prefix + c) > 0, F.lit(X.REASON_LARGE + c)).otherwise(F.lit(X.REASON_SMALL + c))
        raw = F.when(pf == c, branch) if raw is None else raw.when(pf == c, branch)
    reason = (raw.when(pf == "trade_ratio", F.lit(X.REASON_RATIO))
              .when(pf.isin("gas_value", "gas_price"), F.lit(X.REASON_GAS))
              .when(pf == "gas_cost_relative", F.lit(X.REASON_GAS_RELATIVE))
              .otherwise(F.lit(X.REASON_TIME)))
    return df.withColumn("reason", F.when(is_anomaly, reason).otherwise(F.lit(X.REASON_NO_ANOMALY)))
