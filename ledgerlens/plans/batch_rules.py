"""Rule-based batch job: messages -> nested trades -> rules -> scored table.

One scan, one shuffle (the rapid-rule window), one append."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas
from ..operators import rules as R
from ..sources import messages as M

TIME = "block.timestamp.unixtime"


def score_parsed(trades: DataFrame, history: DataFrame | None = None, bounds: tuple | None = None,
                 trader_col: str = "trader_address", skip_reprocessed: bool = False, **rule_args) -> DataFrame:
    """Scored batch trades (table 1 layout) from parsed nested trades.

    ``history`` is the scored sink table (or any frame of that layout); only
    rows in ``[min - 180, max]`` of the batch are read from it. ``bounds``
    may pass the batch (min, max) if the caller knows them; otherwise one
    small aggregation computes them. ``skip_reprocessed`` leaves out history rows
    of the batch's own trades, so that a batch can run again."""
    t = R.required_filter(trades)
    t = R.rule_flags(t, flash_threshold=rule_args.get("flash_threshold", R.X.FLASH_THRESHOLD))
    t = R.evaluate_trade(t, min_amount=rule_args.get("min_amount", R.X.MIN_VALID_AMOUNT))
    hist = None
    if history is not None:
        lo, hi = bounds if bounds is not None else R.time_bounds(t, TIME)
        hist = R.history_scan(history, lo, hi, TIME, rule_args.get("seconds", R.X.RAPID_SECONDS))
        if skip_reprocessed:
            hist = R.exclude_reprocessed(hist, t, TIME)
    t = R.rapid_transactions(t, hist, trader_col=trader_col, time_col=TIME, hash_col="transaction.hash",
                             seconds=rule_args.get("seconds", R.X.RAPID_SECONDS),
                             max_count=rule_args.get("max_count", R.X.RAPID_MAX_COUNT))
    t = R.fraud_flag(t)
    return schemas.conform(t, schemas.BATCH_SCORED)


def batch_score(raw_messages: DataFrame, history: DataFrame | None = None, value_col: str = "value",
                trader_col: str = "transaction.hash", skip_reprocessed: bool = False, **rule_args) -> DataFrame:
    """The whole rule job over raw JSON messages (one per row in ``value``)."""
    parsed = M.parse_messages(raw_messages, value_col=value_col, trader_col=trader_col)
    return score_parsed(parsed, history, skip_reprocessed=skip_reprocessed, **rule_args)


def append_scored(scored: DataFrame, path: str) -> None:
    """Append to the scored table, partitioned by block date so the history
    scan of the next batch prunes whole days. Rebalancing by date gives a day few
    files, and splits a very busy day over several."""
    from pyspark.sql import functions as F
    (scored.withColumn("block_date", F.to_date(F.timestamp_seconds(F.col(TIME))))
     .hint("rebalance", "block_date").write.mode("append").partitionBy("block_date").parquet(path))
