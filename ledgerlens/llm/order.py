"""Distributed ranks and running totals, shared by the manifest and the mixture.

No key is ever gathered: rows are cut into bounded cells (a range partition, or
a slice of a hash), totalled inside each cell, and shifted by the totals of the
cells before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

#: Rows of a hash cell, about.
CELL_ROWS = 4096


def _shifted(cells: DataFrame, keys: Sequence[str], cell: str, sums: dict[str, str]) -> DataFrame:
    """Per (keys, cell) the totals of all earlier cells of the keys."""
    totals = cells.groupBy(*keys, cell).agg(*[F.sum(v).alias(f"__{k}_base") for k, v in sums.items()])
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, cell, *[F.coalesce(F.sum(f"__{k}_base").over(before), F.lit(0)).alias(f"__{k}_base")
                                        for k in sums])


def _running(cells: DataFrame, keys: Sequence[str], cell: str, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    inside = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cells.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__{k}_here") for k, v in sums.items()])
    joined = local.join(_shifted(cells, keys, cell, sums), [*keys, cell])
    return joined.select(*[c for c in cells.columns if c != cell],
                         *[(F.col(f"__{k}_here") + F.col(f"__{k}_base")).alias(k) for k in sums])


def range_running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, str],
                  name: str) -> DataFrame:
    """Adds per entry ``new: column`` the total of ``column`` over the earlier
    rows of the same (non-null) keys in the given order. Rows are dealt by range
    and written once, so that each row's cell is a stored fact."""
    by = [F.col(k) for k in keys] + list(order)
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__cell", F.spark_partition_id())
    return _running(shared_table(dealt, name), keys, "__cell", order, sums)


def hash_cell(digest: Column, cells: Column) -> Column:
    """Slice of a hex digest's first 32 bits: 0 .. cells - 1, rising with the digest."""
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * cells.cast("long"), 32)


def hash_running(df: DataFrame, keys: Sequence[str], digest: str, rows: Column, sums: dict[str, str]) -> DataFrame:
    """The same in the order of a hex digest, unique within the keys; ``rows``
    is about the number of rows of the keys."""
    cells = df.withColumn("__cell", hash_cell(F.col(digest), F.ceil(rows / F.lit(CELL_ROWS))))
    return _running(cells, keys, "__cell", [F.col(digest)], sums)
