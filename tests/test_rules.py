import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import rules as R

FLAT = "tx_hash string, block_unixtime long, buy_amount double, sell_amount double, " \
       "buy_currency string, sell_currency string"


def test_flash_same_token_and_evaluation_boundaries(spark):
    nan = float("nan")
    rows = [("a", 1, 1_000_000.0, 1.0, "X", "Y"), ("b", 1, 1_000_000.01, 1.0, "X", "X"),
            ("c", 1, nan, nan, None, None), ("d", 1, 0.01, 2e6, "X", None), ("e", 1, 0.0099, 1.0, None, "Y"),
            ("f", 1, None, None, "Z", "Z")]
    df = spark.createDataFrame(rows, FLAT)
    out = R.evaluate_trade(R.rule_flags(df, "buy_amount", "sell_amount", "buy_currency", "sell_currency"),
                           "buy_amount")
    got = {r.tx_hash: (r.is_flash_trade, r.is_same_token, r.evaluation) for r in out.collect()}
    assert got["a"] == (False, False, "Valid")          # exactly 1e6 is not above
    assert got["b"] == (True, True, "Valid")
    assert got["c"] == (False, False, "Valid")          # NaN: never flash, compares false for < 0.01
    assert got["d"] == (True, False, "Valid")           # 0.01 is valid; null symbol never same
    assert got["e"] == (False, False, "Invalid")        # just below 0.01
    assert got["f"] == (False, True, "Invalid")         # null amount


def _rapid(df, history=None, **kw):
    return R.rapid_transactions(df, history, trader_col="tx_hash", time_col="block_unixtime",
                                hash_col="tx_hash", **kw)


def test_rapid_frame_edges_ties_and_nulls(spark):
    # trader t: 4 rows inside 180 s (count 4 -> rapid), gap of 181 s breaks the frame
    rows = [("t", 0), ("t", 60), ("t", 120), ("t", 180), ("t", 361), ("u", 0), ("u", 0), ("u", 0)]
    df = spark.createDataFrame([(h, ts, 1.0, 1.0, "A", "B") for h, ts in rows], FLAT)
    got = sorted((r.tx_hash, r.block_unixtime, r.transactions_in_window, r.is_rapid_transaction)
                 for r in _rapid(df).collect())
    assert got == [("t", 0, 1, False), ("t", 60, 2, False), ("t", 120, 3, False), ("t", 180, 4, True),
                   ("t", 361, 1, False), ("u", 0, 3, False), ("u", 0, 3, False), ("u", 0, 3, False)]


def test_rapid_gap_exactly_180_is_inside(spark):
    df = spark.createDataFrame([("t", 0, 1.0, 1.0, "A", "B"), ("t", 180, 1.0, 1.0, "A", "B")], FLAT)
    assert sorted(r.transactions_in_window for r in _rapid(df).collect()) == [1, 2]


def test_rapid_null_hash_not_counted(spark):
    df = spark.createDataFrame([("t", 0, 1.0, 1.0, "A", "B"), ("t", 10, 1.0, 1.0, "A", "B")], FLAT)
    df = df.withColumn("trader", F.lit("x")).withColumn("tx_hash", F.when(F.col("block_unixtime") == 0, None)
                                                        .otherwise(F.col("tx_hash")))
    out = R.rapid_transactions(df, None, trader_col="trader", time_col="block_unixtime", hash_col="tx_hash")
    assert sorted(r.transactions_in_window for r in out.collect()) == [0, 1]


def test_rapid_history_counts_but_is_not_returned(spark):
    batch = spark.createDataFrame([("t", 1000, 1.0, 1.0, "A", "B")], FLAT)
    hist = spark.createDataFrame([("t", 820, 1.0, 1.0, "A", "B"), ("t", 900, 1.0, 1.0, "A", "B"),
                                  ("t", 950, 1.0, 1.0, "A", "B"), ("t", 819, 1.0, 1.0, "A", "B")], FLAT)
    out = _rapid(batch, hist).collect()
    assert len(out) == 1 and out[0].transactions_in_window == 4 and out[0].is_rapid_transaction


def test_rapid_is_row_preserving_with_many_trades_per_hash(spark):
    # one transaction with 5 trades: the reference's join-back gave n^2 rows
    df = spark.createDataFrame([("h", 5, float(i), 1.0, "A", "B") for i in range(5)], FLAT)
    assert _rapid(df).count() == 5


def test_bucketed_window_equals_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        rows.append((f"k{rnd.randint(0, 20)}", rnd.randint(0, 5 * 86400), 1.0, 1.0, "A", "B"))
    # cluster some rows around day boundaries so the halo matters
    for d in range(1, 5):
        for _ in range(50):
            rows.append((f"k{rnd.randint(0, 3)}", d * 86400 + rnd.randint(-200, 200), 1.0, 1.0, "A", "B"))
    df = spark.createDataFrame(rows, FLAT)
    plain = df.withColumn("n", F.count("tx_hash").over(
        Window.partitionBy("tx_hash").orderBy("block_unixtime").rangeBetween(-180, 0)))
    ours = _rapid(df, bucket_seconds=3600)
    a = sorted((r.tx_hash, r.block_unixtime, r.n) for r in plain.collect())
    b = sorted((r.tx_hash, r.block_unixtime, r.transactions_in_window) for r in ours.collect())
    assert a == b


def test_null_audit_and_required_filter(spark):
    from ledgerlens import schemas
    from ledgerlens.sources import messages as M
    raw = spark.createDataFrame([
        ('{"data":{"ethereum":{"dexTrades":[{"protocol":"p","block":{"timestamp":{"time":"t","unixtime":1},'
         '"height":1},"transaction":{"hash":"h"},"buyCurrency":{"symbol":"A","address":"a"},"buyAmount":1}]}}}',),
        ('{"data":{"ethereum":{"dexTrades":[{"protocol":"p","buyAmount":"1.5"}]}}}',)], "value string")
    p = M.parse_messages(raw)
    audit = R.null_audit(p).first()
    assert audit.rows == 2 and audit.null_block == 1 and audit.null_transaction == 1
    assert R.required_filter(p).count() == 1
    assert schemas.conform(p, schemas.BATCH_SCORED).columns == schemas.BATCH_SCORED.fieldNames()


def test_bucketed_window_with_history_equals_plain_union_window(spark):
    rnd = random.Random(11)
    hist_rows = [(f"k{rnd.randint(0, 5)}", rnd.randint(0, 3 * 86400), 1.0, 1.0, "A", "B") for _ in range(800)]
    batch_rows = [(f"k{rnd.randint(0, 5)}", rnd.randint(0, 3 * 86400), 1.0, 1.0, "A", "B") for _ in range(800)]
    hist = spark.createDataFrame(hist_rows, FLAT).withColumn("trader", F.concat(F.col("tx_hash"), F.lit("")))
    batch = spark.createDataFrame(batch_rows, FLAT).withColumn("trader", F.concat(F.col("tx_hash"), F.lit("")))
    ours = R.rapid_transactions(batch, hist, trader_col="trader", time_col="block_unixtime", hash_col="tx_hash",
                                bucket_seconds=7200)
    u = batch.withColumn("cur", F.lit(True)).unionByName(hist.withColumn("cur", F.lit(False)))
    plain = u.withColumn("n", F.count("tx_hash").over(
        Window.partitionBy("trader").orderBy("block_unixtime").rangeBetween(-180, 0))).where("cur")
    a = sorted((r.trader, r.block_unixtime, r.n) for r in plain.collect())
    b = sorted((r.trader, r.block_unixtime, r.transactions_in_window) for r in ours.collect())
    assert a == b and len(b) == 800
