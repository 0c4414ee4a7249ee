"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from . import q_extract, q_features, q_graph, q_rules, q_sinks, q_stream  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
