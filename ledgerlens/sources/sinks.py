"""Sinks: appending result tables, the analyzed-flag update and snapshot
reads. Files are written by executors; nothing passes through the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import delete_path, path_exists, scratch_path

# table -> stamp column added at write time
STAMP_COLUMN = {
    "important_addresses": "analysis_timestamp", "network_communities": "analysis_timestamp",
    "in_degree_addresses": "analysis_timestamp", "out_degree_addresses": "analysis_timestamp",
    "community_members": "analysis_timestamp", "token_pairs": "analysis_timestamp",
    "graph_vertices": "analysis_timestamp", "graph_edges": "analysis_timestamp",
    "graph_based_anomalous_addresses": "detection_time",
    "volume_ratio_high_anomalous_addresses": "detection_time",
    "volume_ratio_low_anomalous_addresses": "detection_time",
}


def stamp(df: DataFrame, column: str, as_of) -> DataFrame:
    """Adds the run time as a literal (repeatable, unlike current_timestamp)."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return df.withColumn(column, F.lit(as_of).cast("timestamp"))


def prepare(name: str, df: DataFrame, as_of) -> DataFrame:
    """Stamp and conform one result frame to its table schema."""
    schema = schemas.RESULT_TABLES[name]
    if "latest_timestamp" in df.columns and df.schema["latest_timestamp"].dataType.typeName() in ("long", "integer"):
        df = df.withColumn("latest_timestamp", F.timestamp_seconds("latest_timestamp"))   # epoch -> timestamp
    col = STAMP_COLUMN.get(name)
    if col and col in schema.fieldNames():
        df = stamp(df, col, as_of)
    return schemas.conform(df, schema)


# What the stored graph columns mean; kept with the table.
COLUMN_COMMENTS = {
    "graph_vertices": {
        "id": "address", "total_buy_volume": "sum of bought amounts", "buy_transactions": "trades as buyer",
        "total_sell_volume": "sum of sold amounts", "sell_transactions": "trades as seller",
        "symbol": "smallest bought token, else smallest sold token", "total_transactions": "trades on either side",
        "total_volume": "bought plus sold amounts", "analysis_timestamp": "run that wrote the row"},
    "graph_edges": {
        "src": "selling address", "dst": "buying address", "total_buy_value": "sum of bought amounts",
        "total_sell_value": "sum of sold amounts", "transaction_count": "trades of the pair",
        "avg_gas_price": "mean gas price", "latest_timestamp": "time of the last trade",
        "weight": "trade count as a number", "analysis_timestamp": "run that wrote the row"},
}


def described_schema(name: str) -> T.StructType:
    """The stored schema of a result table with its column comments."""
    notes = COLUMN_COMMENTS.get(name, {})
    return T.StructType([T.StructField(f.name, f.dataType, True, {"comment": notes[f.name]} if f.name in notes else {})
                         for f in schemas.RESULT_TABLES[name].fields])


def ensure_table(spark: SparkSession, name: str, base_path: str) -> bool:
    """Create ``<base_path>/<name>`` as an empty Parquet table with described
    columns unless it is there; returns whether it was created. The comments are
    stored in the file's schema, so a later read shows them."""
    path = f"{base_path.rstrip('/')}/{name}"
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], described_schema(name)).coalesce(1).write.mode("ignore").parquet(path)
    return True


def create_table(spark: SparkSession, table: str, name: str, location: str, partition_by: tuple = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` in the session's catalog for a result table,
    with its column comments; the data live in ``location``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        + (f" COMMENT '{f.metadata['comment']}'" if "comment" in f.metadata else "")
                        for f in described_schema(name).fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts} LOCATION '{location}'")


def append_table(df: DataFrame, table: str, name: str, as_of) -> int:
    """Append one stamped, conformed result frame to a catalog table by column
    name; returns the rows written, counted by the write itself."""
    seen = Observation()
    out = prepare(name, df, as_of).observe(seen, F.count(F.lit(1)).alias("n"))
    stored = df.sparkSession.table(table)
    out.select(*stored.columns).write.insertInto(table)
    return seen.get["n"]


def save_results(results: dict, base_path: str, as_of, mode: str = "append",
                 skip_empty: bool = True) -> dict[str, int]:
    """Append every result frame to ``<base_path>/<table>`` (Parquet), stamped
    and conformed. Returns the rows written per table, counted by the write
    itself: no frame is computed twice. An empty frame is left out, and the
    folder that its write made is removed."""
    spark, written = next(iter(results.values())).sparkSession if results else None, {}
    for name, df in results.items():
        path, seen = f"{base_path.rstrip('/')}/{name}", Observation()
        there = path_exists(spark, path)
        prepare(name, df, as_of).observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
        rows = seen.get["n"]
        if rows or not skip_empty:
            written[name] = rows
        elif not there:
            delete_path(spark, path)
    return written


def latest_snapshot(df: DataFrame, column: str = "analysis_timestamp") -> DataFrame:
    """Rows of the latest run of an appended snapshot table (graph tables are
    appended every run; readers want one run). The max is a scalar subquery,
    so no driver round-trip and no join."""
    latest = df.select(F.max(column)).scalar()
    return df.where(F.col(column) == latest)


def mark_analyzed(trades: DataFrame, processed: DataFrame, key: str = "tx_hash") -> DataFrame:
    """``analyzed`` set to true on every row whose key was processed (also
    rows not loaded by the run); other rows unchanged. Row-preserving: the
    processed keys are de-duplicated by a partial aggregation, then one left
    equi-join (AQE picks broadcast or sort-merge from the measured size)."""
    keys = processed.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    j = trades.join(keys, key, "left")
    return (j.withColumn("analyzed", F.coalesce(F.col("_hit"), F.lit(False)) | F.coalesce("analyzed", F.lit(False)))
            .drop("_hit").select(*trades.columns))


def write_snapshot(df: DataFrame, path: str, partition_by=None) -> str:
    """Write a new version of a table to a new folder (never overwrite a path
    being read); the caller swaps its pointer to it."""
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def update_analyzed(spark: SparkSession, path: str, processed: DataFrame, partition: str,
                    key: str = "tx_hash") -> int:
    """Set ``analyzed`` on the processed keys of a stored, partitioned trades
    table and return the number of rows updated.

    Only partitions that hold a row to update are rewritten: they are staged
    first (the folder being read is never written), then swapped in by a dynamic
    partition overwrite; all other folders keep their files. A run that is cut
    off can be repeated. The list of partitions is bounded by the folders."""
    table = spark.read.parquet(path)
    keys = processed.select(key).where(F.col(key).isNotNull()).distinct()
    stale = ~F.coalesce(F.col("analyzed"), F.lit(False))
    touched = [r[0] for r in table.where(stale).join(keys, key, "left_semi").select(partition).distinct().collect()]
    if not touched:
        return 0
    seen, staging = Observation(), scratch_path(spark, "analyzed-staging")
    old = table.where(F.col(partition).isin([t for t in touched if t is not None]) |
                      (F.col(partition).isNull() if None in touched else F.lit(False)))
    marked = mark_analyzed(old.withColumn("_was", ~stale), processed, key)
    marked.observe(seen, F.count_if(F.col("analyzed") & ~F.col("_was")).alias("n")).drop("_was").write.parquet(staging)
    spark.read.schema(table.schema).parquet(staging).hint("rebalance", partition).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    delete_path(spark, staging)
    return seen.get["n"]
