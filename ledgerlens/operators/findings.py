"""Cross-pipeline findings: per-transaction correlation of the rule flag,
the stream anomaly flag and the graph address flag; a daily report; alerts
raised by several pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIPELINES = ("rule_flag", "stream_flag", "graph_flag")


def graph_trade_flags(trades: DataFrame, flagged: DataFrame, key: str = "tx_hash") -> DataFrame:
    """(key, graph_flag): false for every trade, and true for each side of it
    that is a flagged address; ``correlate`` takes the largest per key.

    Sellers are looked up once per transaction, and only what is flagged goes on
    from the two lookups: the trades are dealt out by buyer alone."""
    ids = flagged.select(F.col("id").alias("_a")).where(F.col("_a").isNotNull()).distinct()
    out = trades.select(key, F.lit(False).alias("graph_flag"))
    for side in (trades.select(key, F.col("sell_address").alias("_a")).distinct(), trades.select(key, F.col("buy_address").alias("_a"))):
        out = out.unionByName(side.join(ids, "_a", "left_semi").select(key, F.lit(True).alias("graph_flag")))
    return out


def correlate(rule: DataFrame, stream: DataFrame, graph: DataFrame, key: str = "tx_hash",
              time_col: str = "block_unixtime") -> DataFrame:
    """One row per transaction: ``rule_flag``, ``stream_flag``,
    ``graph_flag`` (any trade of the transaction flagged), ``pipelines`` (how
    many flagged it) and ``first_seen`` (earliest trade time).

    Inputs are per-trade frames with (key, flag[, time]); each is reduced
    per key by a partial aggregation before the two full outer joins."""
    r = rule.groupBy(key).agg(F.max("is_fraud").alias("rule_flag"), F.min(time_col).alias("_t1"))
    s = stream.groupBy(key).agg(F.max("is_anomaly").alias("stream_flag"), F.min(time_col).alias("_t2"))
    g = graph.groupBy(key).agg(F.max("graph_flag").alias("graph_flag"))
    j = r.join(s, key, "full").join(g, key, "full")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in PIPELINES]
    out = j.select(key, *flags, F.least("_t1", "_t2").alias("first_seen"))
    return out.withColumn("pipelines", sum(F.col(c).cast("int") for c in PIPELINES))


def report(correlated: DataFrame) -> DataFrame:
    """Flagged transactions per day (of first sight) and pipeline."""
    day = F.to_date(F.timestamp_seconds("first_seen")).cast("string").alias("day")
    stacked = correlated.select(day, F.explode(F.array(*[
        F.struct(F.lit(c).alias("pipeline"), F.col(c).alias("flag")) for c in PIPELINES])).alias("p"))
    return (stacked.where(F.col("p.flag")).groupBy("day", F.col("p.pipeline").alias("pipeline"))
            .agg(F.count(F.lit(1)).alias("flagged")))


def alerts(correlated: DataFrame, min_pipelines: int = 2) -> DataFrame:
    """Transactions flagged by at least ``min_pipelines`` pipelines."""
    return correlated.where(F.col("pipelines") >= min_pipelines)
