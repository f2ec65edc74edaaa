"""Technical indicators (RSI, MACD, Bollinger bands, stochastic
oscillator, on-balance volume), all shifted by one row as the reference
uses them.  Window lengths are parameters with the reference's defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import panel_window, roll, running, safe_div, shift
from .smoothing import ewm_mean

TECHNICAL = ("rsi", "macd", "macd_signal", "macd_indicator", "upper_bollinger",
             "lower_bollinger", "stochastic_d", "stochastic_k", "obv")


def rsi(df: DataFrame, window: int = 21, key="symbol", order="date",
        out: str = "rsi") -> DataFrame:
    """Relative strength index from adjusted EWMs (com = window-1,
    min_periods = window) of gains and losses; a missing first change counts
    as 0 (P8).  ``100 - 100/(1+g/l)``; 100 when there are no losses (g/l is
    +inf in pandas) and NULL when there is no movement at all."""
    w = panel_window(key, order)
    dlt = F.col("close") - F.lag("close", 1).over(w)
    d = (df.withColumn("_gain", F.when(dlt > 0, dlt).otherwise(F.lit(0.0)))
           .withColumn("_loss", F.when(dlt < 0, -dlt).otherwise(F.lit(0.0))))
    d = ewm_mean(d, "_gain", "_g", com=window - 1, adjust=True, min_periods=window,
                 key=key, order=order)
    d = ewm_mean(d, "_loss", "_l", com=window - 1, adjust=True, min_periods=window,
                 key=key, order=order)
    g, lo = F.col("_g"), F.col("_l")
    raw = (F.when(g + lo == 0, F.lit(None).cast("double"))
            .when(lo == 0, F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + safe_div(g, lo))))
    return d.withColumn(out, shift(raw, 1, w)).drop("_gain", "_loss", "_g", "_l")


def macd(df: DataFrame, short_window: int = 21, long_window: int = 50,
         signal_window: int = 15, key="symbol", order="date") -> DataFrame:
    """MACD line (EWM com=short minus EWM com=long, adjust=False), signal line
    (EWM span=signal of the MACD line) and their difference, shifted."""
    w = panel_window(key, order)
    d = ewm_mean(df, "close", "_es", com=short_window, adjust=False, key=key, order=order)
    d = ewm_mean(d, "close", "_el", com=long_window, adjust=False, key=key, order=order)
    d = d.withColumn("_macd", F.col("_es") - F.col("_el"))
    d = ewm_mean(d, "_macd", "_sig", span=signal_window, adjust=False, key=key, order=order)
    return (d.withColumn("macd", shift("_macd", 1, w))
             .withColumn("macd_signal", shift("_sig", 1, w))
             .withColumn("macd_indicator", shift(F.col("_macd") - F.col("_sig"), 1, w))
             .drop("_es", "_el", "_macd", "_sig"))


def bollinger(df: DataFrame, window: int = 20, k: float = 2.0, key="symbol",
              order="date") -> DataFrame:
    """Bands at mean +- k sample standard deviations over ``window`` rows, shifted."""
    w = panel_window(key, order)
    mid = roll(F.avg, "close", window, w)
    sd = roll(F.stddev_samp, "close", window, w)
    d = df.withColumn("_mid", mid).withColumn("_sd", sd)
    return (d.withColumn("upper_bollinger", shift(F.col("_mid") + F.lit(k) * F.col("_sd"), 1, w))
             .withColumn("lower_bollinger", shift(F.col("_mid") - F.lit(k) * F.col("_sd"), 1, w))
             .drop("_mid", "_sd"))


def stochastic(df: DataFrame, window: int = 21, smoothing_window: int = 3,
               key="symbol", order="date") -> DataFrame:
    """%K = (close - min low) / (max high - min low) * 100 over ``window`` rows,
    %D = mean of ``smoothing_window`` %K values; both shifted."""
    w = panel_window(key, order)
    lo = roll(F.min, "low", window, w)
    hi = roll(F.max, "high", window, w)
    d = df.withColumn("_k", safe_div(F.col("close") - lo, hi - lo) * F.lit(100.0))
    d = d.withColumn("_d", roll(F.avg, "_k", smoothing_window, w))
    return (d.withColumn("stochastic_d", shift("_d", 1, w))
             .withColumn("stochastic_k", shift("_k", 1, w))
             .drop("_k", "_d"))


def obv(df: DataFrame, key="symbol", order="date") -> DataFrame:
    """On-balance volume: running sum of sign(close change) * volume, 0 on the
    first row, shifted.  The reference's Python loop is one running sum."""
    w = panel_window(key, order)
    step = F.signum(F.coalesce(F.col("close") - F.lag("close", 1).over(w), F.lit(0.0)))
    d = df.withColumn("_obv", F.sum(step * F.col("volume")).over(running(w)))
    return d.withColumn("obv", shift("_obv", 1, w)).drop("_obv")


def technical_indicators(df: DataFrame, key="symbol", order="date") -> DataFrame:
    """All nine technical columns of the reference panel."""
    d = rsi(df, key=key, order=order)
    d = macd(d, key=key, order=order)
    d = bollinger(d, key=key, order=order)
    d = stochastic(d, key=key, order=order)
    return obv(d, key=key, order=order)
