"""Rule scoring of trades: flash volume, same-token swap, amount evaluation,
rapid sequences (range-window count against history) and the final flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..session import stored

CURRENT, HISTORICAL = "current_batch", "historical"


def required_filter(df: DataFrame, cols=("block", "block.timestamp", "transaction", "buyCurrency")) -> DataFrame:
    """Keep rows whose required fields are all non-null. Tested on the source
    structs, before any ``struct(...)`` rebuild (a rebuilt struct is never
    null). A plain filter: it fuses into the scan stage."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def null_audit(df: DataFrame, cols=("block", "block.timestamp", "transaction", "buyCurrency")) -> DataFrame:
    """Null count per required field, all in one aggregation (one job, with
    partial aggregation per task)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c.replace('.', '_')}") for c in cols],
                  F.count(F.lit(1)).alias("rows"))


def rule_flags(df: DataFrame, buy="buyAmount", sell="sellAmount", buy_symbol="buyCurrency.symbol",
               sell_symbol="sellCurrency.symbol", flash_threshold: float = X.FLASH_THRESHOLD) -> DataFrame:
    """Adds ``is_flash_trade`` (an amount above the threshold; null / NaN
    false) and ``is_same_token`` (both symbols equal and non-null)."""
    return (df.withColumn("is_flash_trade", X.flash_flag(buy, sell, flash_threshold))
              .withColumn("is_same_token", X.same_token_flag(buy_symbol, sell_symbol)))


def evaluate_trade(df: DataFrame, amount="buyAmount", min_amount: float = X.MIN_VALID_AMOUNT) -> DataFrame:
    """Adds ``evaluation``: "Invalid" for a null amount or one below
    ``min_amount``, else "Valid"."""
    return df.withColumn("evaluation", X.evaluation(amount, min_amount))


def time_bounds(df: DataFrame, time_col: str) -> tuple:
    """(min, max) event time of a batch in one aggregation; nulls skipped."""
    r = df.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    return (r["lo"], r["hi"]) if r is not None else (None, None)


def history_scan(history: DataFrame, lo, hi, time_col: str = "block.timestamp.unixtime",
                 lookback: int = X.RAPID_SECONDS) -> DataFrame:
    """History rows that can fall in a rule frame of the batch:
    ``lo - lookback <= t <= hi``. Literal bounds, so the predicate reaches
    the Parquet scan (row-group skipping on the time column); on the scored
    table, partitioned by ``block_date``, the same bounds prune partitions."""
    if lo is None or hi is None:
        return history.limit(0)
    lo_s, hi_s = int(lo) - lookback, int(hi)
    out = history.where(F.col(time_col).between(F.lit(lo_s), F.lit(hi_s)))
    if "block_date" in history.columns:
        # the scored table is partitioned by block date: prune whole folders too
        day = lambda t: F.to_date(F.timestamp_seconds(F.lit(t)))
        out = out.where(F.col("block_date").between(day(lo_s), day(hi_s)))
    return out


def exclude_reprocessed(history: DataFrame, batch: DataFrame, time_col: str = "block.timestamp.unixtime",
                        hash_col: str = "transaction.hash") -> DataFrame:
    """History rows that are not in the batch: a batch that runs again finds its
    own rows in the scored table and must not count them twice. Null-safe on
    (hash, time); the batch's keys are made distinct by partial sums and written,
    so that the join's sides are plain exchanges and a hot key can be split."""
    keys = stored(batch.select(F.col(hash_col).alias("_h"), F.col(time_col).alias("_t")).distinct(), "batch-keys")
    return history.join(keys, F.col(hash_col).eqNullSafe(F.col("_h")) & F.col(time_col).eqNullSafe(F.col("_t")), "left_anti")


def rapid_transactions(batch: DataFrame, history: DataFrame | None = None,
                       trader_col: str = "trader_address", time_col: str = "block.timestamp.unixtime",
                       hash_col: str = "transaction.hash", seconds: int = X.RAPID_SECONDS,
                       max_count: int = X.RAPID_MAX_COUNT, bucket_seconds: int = 3600) -> DataFrame:
    """Adds ``transactions_in_window`` and ``is_rapid_transaction`` to every
    batch row, row-preserving.

    The count is ``count(hash)`` over the rows of the same trader with time in
    ``[t - seconds, t]`` (ties are peers, a null hash is not counted), taken
    over history UNION ALL batch; only batch rows are returned.

    Scale: a plain ``Window.partitionBy(trader)`` would put a hot trader (a
    third of all rows) in one task. Rows are instead partitioned by
    (trader, time bucket of ``bucket_seconds``); each row within ``seconds``
    of its bucket's end is copied into the next bucket as a non-output halo
    row, so every frame is complete inside one (trader, bucket) partition.
    The copy is ``seconds / bucket_seconds`` of the rows (5 % with hourly
    buckets). Null traders count together like any trader, hour by hour; rows
    without a time form one group per trader.
    """
    if seconds >= bucket_seconds:
        raise ValueError("bucket_seconds must exceed the frame length")
    cur = batch.withColumn("_src", F.lit(CURRENT)).withColumn("_trader", F.col(trader_col)) \
        .withColumn("_ts", F.col(time_col)).withColumn("_hash", F.col(hash_col))
    rows = cur
    if history is not None:
        hist = history.select(F.col(trader_col).alias("_trader"), F.col(time_col).alias("_ts"),
                              F.col(hash_col).alias("_hash"), F.lit(HISTORICAL).alias("_src"))
        rows = cur.unionByName(hist, allowMissingColumns=True)
    b = F.floor(F.col("_ts") / F.lit(bucket_seconds))
    in_halo = F.pmod(F.col("_ts"), F.lit(bucket_seconds)) >= F.lit(bucket_seconds - seconds)
    rows = (rows.withColumn("_home", b)
            .withColumn("_bkt", F.explode(F.when(in_halo, F.array(b, b + 1)).otherwise(F.array(b)))))
    w = (Window.partitionBy("_trader", "_bkt").orderBy("_ts")
         .rangeBetween(-seconds, Window.currentRow))
    counted = rows.withColumn("transactions_in_window", F.count("_hash").over(w))
    out = counted.where((F.col("_src") == CURRENT) & F.col("_bkt").eqNullSafe(F.col("_home")))
    out = out.withColumn("is_rapid_transaction",
                         F.coalesce(F.col("transactions_in_window") > F.lit(max_count), F.lit(False)))
    return out.drop("_src", "_trader", "_ts", "_hash", "_home", "_bkt")


def fraud_flag(df: DataFrame) -> DataFrame:
    """``is_fraud`` = flash OR same token OR rapid OR evaluation "Invalid";
    a missing flag counts as false."""
    f = lambda c: F.coalesce(F.col(c), F.lit(False))
    return df.withColumn("is_fraud", f("is_flash_trade") | f("is_same_token") | f("is_rapid_transaction")
                         | F.coalesce(F.col("evaluation") == "Invalid", F.lit(False)))
