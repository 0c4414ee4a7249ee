import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"tx_hash", "is_fraud", "transactions_in_window"} <= set(df.columns)


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_small_keys_have_the_rows_of_their_sql(spark):
    import duckdb

    from tests.conftest import SF001
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("lineitem", "orders", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    q, o = E.queries(), E.oracle_sql()
    for k in ["parse_messages", "malformed_messages", "rapid_transactions", "window_zscore", "graph_vertices",
              "viz_volume_ladder", "mark_analyzed", "alerts"]:
        want = con.execute(f"SELECT count(*) FROM ({o[k]})").fetchone()[0]
        assert q[k](spark, SF001).count() == want > 0


def test_queries_stand_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys
    have = set(E.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)       # its import fails
    try:
        alone = importlib.reload(E)
        assert len(alone.queries()) >= 60 and not any(k.startswith("op") or k == "pipeline" for k in alone.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(E)
    assert set(E.queries()) == have
