"""The price windows, indicators and quantile label for series of any length.

Same values as :mod:`price`, :mod:`indicators` and :mod:`labels`, but no window
covers a whole symbol: rows are numbered in range slices once, sliding windows
run in blocks with a halo, running values are carried between slices.  Use these
where a symbol has more rows than a task should hold (minute bars, ticks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, panel_window, roll, safe_div, shift
from ..functions.selection import exact_percentile
from ..functions.slices import (POS, SLICE, ewm_scan, joined, names, numbered, previous, segmented_scan,
                                sliding_extreme, windowed)
from .price import PRICE_REACH, price_features

SCANNED = ("close_filled", "obv", "rsi", "macd", "macd_signal", "macd_indicator")


def long_price_features(bars: DataFrame, key="symbol", order="date", block_rows: int | None = None) -> DataFrame:
    """W1-W11 by halo windows; the fill of missing closes is carried between slices."""
    rows = numbered(bars, key, order, scans={"_pad": ("last", "close")})
    out = windowed(rows, lambda d, k: price_features(d, key=k, order=order, padded="_pad"), key, PRICE_REACH,
                   block_rows=block_rows)
    return out.drop(POS, SLICE, "_pad")


def long_max_drawdown(bars: DataFrame, k: int, key="symbol", order="date", out: str = "max_drawdown",
                      block_rows: int | None = None) -> DataFrame:
    """Least close / (greatest close of k rows) - 1 over k rows, shifted."""
    def compute(d, keys):
        d = sliding_extreme(d, {"_top": ("max", "close")}, k, keys)
        d = d.withColumn("_dd", safe_div("close", "_top") - F.lit(1.0))
        d = sliding_extreme(d, {"_low": ("min", "_dd")}, k, keys)
        return d.withColumn(out, shift("_low", 1, panel_window(keys, order))).drop("_top", "_dd", "_low")

    return windowed(numbered(bars, key, order), compute, key, 2 * k, block_rows=block_rows).drop(POS, SLICE)


def long_stochastic(bars: DataFrame, window: int, smoothing_window: int = 3, key="symbol", order="date",
                    block_rows: int | None = None) -> DataFrame:
    """%K over ``window`` rows and its mean %D, both shifted."""
    def compute(d, keys):
        w = panel_window(keys, order)
        d = sliding_extreme(d, {"_lo": ("min", "low"), "_hi": ("max", "high")}, window, keys, min_periods=window)
        d = d.withColumn("_k", safe_div(F.col("close") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * F.lit(100.0))
        d = d.withColumn("_d", roll(F.avg, "_k", smoothing_window, w))
        return d.withColumns({"stochastic_d": shift("_d", 1, w), "stochastic_k": shift("_k", 1, w)}).drop("_lo", "_hi", "_k", "_d")

    return windowed(numbered(bars, key, order), compute, key, window + smoothing_window + 1,
                    block_rows=block_rows).drop(POS, SLICE)


def long_scans(bars: DataFrame, key="symbol", order="date", rsi_window: int = 21, short: int = 21, long: int = 50,
               signal: int = 15) -> DataFrame:
    """W14, W23, W24, W27 by carries: the forward-filled close, OBV, RSI and MACD.

    Indicators are taken of the filled close and shifted by one row; they start
    with a symbol's first close.
    """
    rows = numbered(bars, key, order, scans={"close_filled": ("last", "close"), "_before": ("last", "close", True)})
    close, before = F.col("close_filled"), F.col("_before")
    known = close.isNotNull()
    move = F.coalesce(close - before, F.lit(0.0))
    rows = rows.withColumns({"_start": known & before.isNull(), "_gain": F.when(known, F.greatest(move, F.lit(0.0))),
                             "_loss": F.when(known, F.greatest(-move, F.lit(0.0))),
                             "_step": F.when(known, F.signum(move) * F.col("volume"))})
    rows = segmented_scan(rows, {"_obv": ("sum", "_step")}, key, order)
    start = F.col("_start")
    rows = ewm_scan(rows, {"_s": "close_filled"}, 1.0 / (1 + short), key, adjust=False, start=start)
    rows = ewm_scan(rows, {"_t": "close_filled"}, 1.0 / (1 + long), key, adjust=False, start=start)
    rows = rows.withColumn("_macd", F.col("_s") - F.col("_t"))
    rows = ewm_scan(rows, {"_sig": "_macd"}, 2.0 / (signal + 1), key, adjust=False, start=start)
    rows = ewm_scan(rows, {"_g": "_gain", "_l": "_loss"}, 1.0 / rsi_window, key, min_periods=rsi_window)
    g, lo = F.col("_g"), F.col("_l")
    rsi = (F.when(g + lo == 0, F.lit(None).cast("double")).when(lo == 0, F.lit(100.0))
           .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + safe_div(g, lo))))
    rows = rows.withColumns({"_rsi": rsi, "_ind": F.col("_macd") - F.col("_sig")})
    rows = previous(rows, {"obv": "_obv", "rsi": "_rsi", "macd": "_macd", "macd_signal": "_sig", "macd_indicator": "_ind"},
                    key, order)
    return rows.select(*bars.columns, *SCANNED)


def long_quantile_label(df: DataFrame, horizon: int = 63, q: float = 0.6, key="symbol", order="date",
                        price="close", limit: int | None = None, block_rows: int | None = None) -> DataFrame:
    """The forward return, the exact quantile of each (symbol, year)
    and the 0/1 label, for groups of any size.  A day without a future is 0."""
    def ahead(d, keys):
        w = panel_window(keys, order)
        return d.withColumn("target_3m_raw", safe_div(F.lead(price, horizon).over(w), F.col(price)) - F.lit(1.0))

    rows = windowed(numbered(df, key, order), ahead, key, 0, horizon, block_rows).drop(POS, SLICE)
    rows = rows.withColumn("_year", F.year(order))
    groups = [*names(key), "_year"]
    bound = exact_percentile(rows, groups, "target_3m_raw", q, "threshold", **({"limit": limit} if limit else {}))
    out = joined(rows, bound, groups)
    return out.withColumn("target_3m", flag(F.col("target_3m_raw") > F.col("threshold"))).drop("_year")
