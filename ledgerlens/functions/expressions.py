"""Scalar column expressions. All are built-in Spark functions, so they run
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
FLASH_THRESHOLD = 1_000_000.0      # flash trade: an amount above this
MIN_VALID_AMOUNT = 0.01            # evaluation: buy amount below this is "Invalid"
RAPID_SECONDS = 180                # rapid rule frame: 180 s preceding .. current row
RAPID_MAX_COUNT = 3                # rapid rule: more than 3 in the frame
SECONDS_PER_DAY = 86400
NAN_POSINF, NAN_NEGINF = 1e10, -1e10   # nan_to_num replacement of +/- infinity

STREAM_FEATURES = [
    "buy_amount", "sell_amount", "trade_ratio", "gas_value",
    "gas_price", "gas_cost_relative", "time_of_day_sin", "time_of_day_cos",
]

# Reason texts of the stream scorer, by primary factor.
REASON_NO_ANOMALY = "No anomaly detected"
REASON_INSUFFICIENT = "Insufficient data for analysis"
REASON_LARGE = "Unusually large "
REASON_SMALL = "Unusually small "
REASON_RATIO = "Unusual price ratio between tokens"
REASON_GAS = "Unusual gas parameters"
REASON_GAS_RELATIVE = "Gas cost disproportionate to transaction size"
REASON_TIME = "Transaction at unusual time of day"
REASON_ERROR = "Error in anomaly detection: "


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gt_not_nan(c, threshold: float) -> Column:
    """``c > threshold`` with Python semantics: NaN and null are false (Spark
    orders NaN above every number, Python compares it false)."""
    c = col_(c)
    return F.coalesce((c > F.lit(threshold)) & ~F.isnan(c), F.lit(False))


def flash_flag(buy, sell, threshold: float = FLASH_THRESHOLD) -> Column:
    return gt_not_nan(buy, threshold) | gt_not_nan(sell, threshold)


def same_token_flag(buy_symbol, sell_symbol) -> Column:
    return F.coalesce(col_(buy_symbol) == col_(sell_symbol), F.lit(False))


def evaluation(buy, min_amount: float = MIN_VALID_AMOUNT) -> Column:
    """"Invalid" when the amount is null or below the minimum, else "Valid"
    (NaN compares false in both engines, so it is "Valid")."""
    buy = col_(buy)
    return F.when(buy.isNull() | (buy < F.lit(min_amount)), F.lit("Invalid")).otherwise(F.lit("Valid"))


def safe_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` (NaN is not > 0), else 0.0.
    Never divides by zero, so ANSI mode cannot raise."""
    num, den = col_(num), col_(den)
    return F.when((den > 0) & ~F.isnan(den), num / den).otherwise(F.lit(0.0))


def _day_angle(unixtime) -> Column:
    return F.lit(2 * math.pi) * F.pmod(col_(unixtime), F.lit(SECONDS_PER_DAY)) / F.lit(float(SECONDS_PER_DAY))


def time_of_day_sin(unixtime) -> Column:
    return F.sin(_day_angle(unixtime))


def time_of_day_cos(unixtime) -> Column:
    return F.cos(_day_angle(unixtime))


def nan_to_num(c) -> Column:
    """NaN -> 0, +inf -> 1e10, -inf -> -1e10 (null kept as 0 as well)."""
    c = col_(c)
    return (F.when(c.isNull() | F.isnan(c), F.lit(0.0))
            .when(c == F.lit(float("inf")), F.lit(NAN_POSINF))
            .when(c == F.lit(float("-inf")), F.lit(NAN_NEGINF))
            .otherwise(c))


def unique_id(tx_hash, unixtime) -> Column:
    """Dedup key ``<hash>_<unixtime>``. A null hash reads "None", so such
    trades keep their time in the id and merge only within one second; null
    when the time is null."""
    return F.when(col_(unixtime).isNotNull(),
                  F.concat_ws("_", F.coalesce(col_(tx_hash), F.lit("None")), col_(unixtime).cast("string")))


def short_address(c, head: int = 10, tail: int = 8) -> Column:
    """``first head chars ... last tail chars`` (display form of an address)."""
    c = col_(c)
    return F.concat(F.substring(c, 1, head), F.lit("..."), F.right(c, F.lit(tail)))


def epoch_window_start(unixtime, seconds: int) -> Column:
    """Start (epoch seconds) of the tumbling window of ``seconds`` holding
    ``unixtime``; the same grid as ``F.window`` with no offset."""
    u = col_(unixtime)
    return u - F.pmod(u, F.lit(int(seconds)))


def parse_duration(window: str | int) -> int:
    """"60 seconds" / "1 day" / "2 hours" / 60 -> seconds."""
    if isinstance(window, (int, float)):
        return int(window)
    n, unit = window.strip().split()
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(n) * mult)
