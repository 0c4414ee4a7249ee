"""Helpers shared by the corpus operators.

Intermediate tables that are read more than once are written as Parquet under
the cluster's shared checkpoint folder (``shared_table``); that cuts the lineage
and survives lost executors. They are removed when the process ends; nothing is
kept on a machine-local folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The six ASCII white-space characters: space, and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name (URI) under the shared checkpoint folder, removed when
    this process ends."""
    return scratch_path(spark, f"llm-{name}")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(c, _UPPER, _UPPER.lower())


def hash128(*cols: Column) -> Column:
    """Two differently seeded 64-bit hashes; together they stand for the value."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(0x5EED), *cols).alias("b"))


def one_per_id(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per id: of different texts that of the smallest hash, so that the
    choice is the same in every run."""
    others = [c for c in rows.columns if c != id_col]
    least = F.min(F.struct(F.xxhash64(text_col).alias("__h"), *others)).alias("__r")
    return rows.groupBy(id_col).agg(least).select(*[F.col(c) if c == id_col else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def text_bytes(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, body): the id as long and the UTF-8 bytes, null text as empty.
    Bytes reach the Python tasks without a decode."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"), *more)


def batches(frames: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``most_bytes`` (one row
    at least): memory stays bounded when texts are very long."""
    for b in frames:
        if b.num_rows == 0:
            continue
        rows = max(1, int(b.num_rows * most_bytes / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
