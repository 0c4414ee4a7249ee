"""ledgerlens: trade-fraud and transaction-graph analytics on Spark.

Every operator is ``DataFrame -> DataFrame`` with the reference thresholds
as keyword defaults:

* rules: ``operators.rules`` (rule_flags, evaluate_trade, history_scan,
  rapid_transactions, fraud_flag) and ``plans.batch_rules.batch_score``;
* stream features: ``operators.features``, ``operators.iforest``,
  ``plans.stream_scorer``, ``streaming.jobs``;
* graph: ``operators.graph``, ``operators.anomaly``, ``operators.extract``,
  ``plans.graph_job``; sinks in ``sources.sinks``; findings in
  ``operators.findings``.
"""

__all__ = ["functions", "operators", "plans", "schemas", "session", "sources", "streaming"]
