from pyspark.sql import functions as F

from ledgerlens.functions import expressions as X
from ledgerlens.operators import features as FT

BASE = ("tx_hash string, block_unixtime long, buy_amount double, sell_amount double, gas_value double, "
        "gas_price double")


def test_extract_features_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", 0, 0.0, 5.0, 1.0, 1.0), ("b", 21600, -2.0, 5.0, 1.0, 1.0), ("c", 43200, nan, 5.0, 1.0, 1.0),
            ("d", 64800, inf, 5.0, 1.0, 1.0), ("e", 86400, 2.0, 5.0, 1.0, 1.0), ("f", None, 2.0, 5.0, 1.0, 1.0),
            ("g", 10, 2.0, None, 1.0, 1.0)]
    out = {r.tx_hash: r for r in FT.extract_features(spark.createDataFrame(rows, BASE)).collect()}
    assert set(out) == {"a", "b", "c", "d", "e"}               # missing time / amount rejected
    assert out["a"].trade_ratio == 0.0 and out["b"].trade_ratio == 0.0 and out["c"].trade_ratio == 0.0
    assert out["d"].trade_ratio == 0.0                         # 5 / inf
    assert out["e"].trade_ratio == 2.5 and out["e"].gas_cost_relative == 0.5
    assert abs(out["b"].time_of_day_sin - 1.0) < 1e-12 and abs(out["e"].time_of_day_cos - 1.0) < 1e-12
    assert out["e"].unique_id == "e_86400" and out["e"].analyzed is False


def test_window_gate_9_vs_10(spark):
    rows = [(f"a{i}", 100 + i, 1.0, 1.0, 1.0, 1.0) for i in range(9)] + \
           [(f"b{i}", 86400 + i, 1.0, 1.0, 1.0, 1.0) for i in range(10)]
    g = FT.window_gate(spark.createDataFrame(rows, BASE), "1 day").collect()
    by = {r.tx_hash[0]: (r.window_rows, r.gated, r.reason) for r in g}
    assert by["a"] == (9, True, X.REASON_INSUFFICIENT) and by["b"] == (10, False, None)


def test_zscore_population_std_and_constant_feature(spark):
    rows = [(f"r{i}", i, float(i), 3.0, 1.0, 1.0) for i in range(4)]
    z = FT.window_zscore(FT.extract_features(spark.createDataFrame(rows, BASE)), "1 day").collect()
    zb = sorted(r.z_buy_amount for r in z)
    # values 0..3: mean 1.5, population std sqrt(1.25)
    assert abs(zb[0] + 1.5 / 1.25 ** 0.5) < 1e-12
    assert all(r.z_gas_value == 0.0 for r in z)                # constant feature: divide by 1


def test_anomaly_reason_first_max_wins(spark):
    cols = X.STREAM_FEATURES
    vals = {c: 0.0 for c in cols}
    vals.update({"z_gas_value": 4.0, "z_gas_price": 4.0, "x_buy_amount": 1.0})
    row = {**{"z_" + c: 0.0 for c in cols}, **{"x_" + c: 0.0 for c in cols}}
    rows = []
    for name, upd in [("gas", {"z_gas_value": 4.0, "z_gas_price": -4.0}),
                      ("small", {"z_buy_amount": -5.0, "x_buy_amount": -1.0}),
                      ("large", {"z_sell_amount": 5.0, "x_sell_amount": 7.0}),
                      ("time", {"z_time_of_day_cos": 9.0}), ("normal", {"z_trade_ratio": 9.0})]:
        rows.append({"name": name, **row, **upd, "flag": name != "normal"})
    df = spark.createDataFrame(rows)
    got = {r.name: (r.primary_factor, r.reason) for r in FT.anomaly_reason(df, F.col("flag")).collect()}
    assert got["gas"] == ("gas_value", X.REASON_GAS)
    assert got["small"][1] == "Unusually small buy_amount"
    assert got["large"][1] == "Unusually large sell_amount"
    assert got["time"][1] == X.REASON_TIME
    assert got["normal"][1] == X.REASON_NO_ANOMALY


def test_window_dedup_keeps_smallest(spark):
    rows = [("h", 10, 5.0, 1.0, 1.0, 1.0), ("h", 10, 3.0, 1.0, 1.0, 1.0), ("h", 86410, 4.0, 1.0, 1.0, 1.0)]
    f = FT.extract_features(spark.createDataFrame(rows, BASE))
    d = FT.window_dedup(f, "1 day").collect()
    assert sorted((r.window_start, r.buy_amount) for r in d) == [(0, 3.0), (86400, 4.0)]


def test_gate_passes_its_minimum(spark):
    from ledgerlens.plans import stream_scorer
    rows = [(f"u{i}", 0, i, *[float(i * k % 7) for k in range(1, 9)]) for i in range(10)]
    df = spark.createDataFrame(rows, "unique_id string, window_start long, block_unixtime long, " +
                               ", ".join(f"{c} double" for c in X.STREAM_FEATURES))
    for least, gated in ((9, 0), (10, 0), (11, 10)):
        out = stream_scorer.score_windows(df, min_rows=least, trees=5).collect()
        assert sum(r["reason"] == X.REASON_INSUFFICIENT for r in out) == gated


def test_null_hashes_keep_their_time(spark):
    rows = [(None, 100), (None, 101), (None, 101), ("h", 100), ("h", 100)]
    df = spark.createDataFrame([(h, t, 1.0, 2.0, 3.0, 4.0) for h, t in rows],
                               "tx_hash string, block_unixtime long, buy_amount double, sell_amount double, "
                               "gas_value double, gas_price double")
    f = FT.extract_features(df)
    assert f.count() == 5 and f.where("unique_id is null").count() == 0
    d = FT.window_dedup(f)
    assert sorted(r["unique_id"] for r in d.collect()) == ["None_100", "None_101", "h_100"]


def test_dedup_before_the_derived_columns_gives_the_same_rows(spark):
    rows = [("p", 1000 + i % 3, 5, f"h{i % 4}", "A", "b", float(i % 5), "B", "s", float(i % 2), 0.1, 1.0) for i in range(40)]
    t = spark.createDataFrame(rows, "protocol string, block_unixtime long, block_height long, tx_hash string, buy_currency string, "
                                    "buy_address string, buy_amount double, sell_currency string, sell_address string, "
                                    "sell_amount double, gas_value double, gas_price double")
    whole = FT.window_dedup(FT.extract_features(t), "60 seconds")
    slim = FT.deduped_features(t, "60 seconds").select(*whole.columns)
    assert sorted(map(str, slim.collect())) == sorted(map(str, whole.collect())) and whole.count() == 12
