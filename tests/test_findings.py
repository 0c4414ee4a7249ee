"""Flags of flagged addresses on trades, against a loop."""

from ledgerlens.operators import findings as FN


def test_graph_flags_per_transaction(spark):
    rows = [("x", "s1", "b1"), ("x", "s1", "b2"), ("y", "s2", "b1"), ("z", "s3", "b3"), ("z", "s3", "b3"), (None, "s9", "b9"),
            (None, None, "b1"), ("n", None, None), ("s", "b1", None), (None, "s1", "b8")]
    flagged = ["s1", "b3", "b3", None, "elsewhere"]
    t = spark.createDataFrame(rows, "tx_hash string, sell_address string, buy_address string")
    f = spark.createDataFrame([(i,) for i in flagged], "id string")
    want = {}
    for key, s, b in rows:
        want[key] = want.get(key, False) or any(a is not None and a in flagged for a in (s, b))
    got = {}
    for r in FN.graph_trade_flags(t, f).collect():
        got[r["tx_hash"]] = got.get(r["tx_hash"], False) or r["graph_flag"]
    assert got == want


def test_only_flagged_rows_leave_the_address_joins(spark):
    rows = [(f"t{i // 7}", f"s{i // 70}", f"b{i % 11}") for i in range(700)]
    t = spark.createDataFrame(rows, "tx_hash string, sell_address string, buy_address string")
    flags = FN.graph_trade_flags(t, spark.createDataFrame([("s3",)], "id string")).where("graph_flag")
    assert flags.count() == 10                 # one per transaction of the seller, not one per trade
