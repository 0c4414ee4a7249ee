"""Registry of named queries (Spark callable + optional DuckDB oracle SQL).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables; its oracle is an independent SQL formulation over the same
parquet files (``trades`` is a CTE built from lineitem / orders / part)."""

from __future__ import annotations

from collections.abc import Callable

from ..sources.tables import TRADES_CTE_SQL

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def with_trades(sql: str) -> str:
    """Prepend the ``trades`` CTE (and chain further CTEs after it)."""
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + TRADES_CTE_SQL + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + TRADES_CTE_SQL + ",\n" + body[5:]
    return "WITH " + TRADES_CTE_SQL + "\n" + body


def register(name: str, oracle: str | None = None, trades_cte: bool = True):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_trades(oracle) if trades_cte else oracle.strip()
        return fn
    return deco
