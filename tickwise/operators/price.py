"""Price and volume features per (symbol, date).

All windows share ``Window.partitionBy(symbol).orderBy(date)``, so the
whole block plans as one hash exchange on ``symbol`` and one sort; stacked
window expressions (a lag of a rolling mean) become further Window nodes on
the same partitioning.  Which features are "shifted" (use only data up to
the previous row) follows the reference exactly:

* shifted: return_1m, sma_*, volatility_*, sharpe_3m, max_drawdown_3m,
  avg_volume_3m, price_vs_sma*;
* same-day: lag_ret_1/5/10, skew_3m, kurt_3m.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (panel_window, pct_change, roll, rolling_kurt,
                                 rolling_skew, safe_div, shift)

PRICE_FEATURES = (
    "return_1m", "sma_50", "sma_200", "sma_ratio", "volatility_3m", "volatility_12m",
    "sharpe_3m", "max_drawdown_3m", "avg_volume_3m", "volume_volatility",
    "lag_ret_1", "lag_ret_5", "lag_ret_10", "skew_3m", "kurt_3m",
    "price_vs_sma50", "price_vs_sma200",
)
#: Rows back that a feature reaches: 252 returns, each of two closes, shifted by one.
PRICE_REACH = 253


def daily_return(df: DataFrame, key="symbol", order="date", pad: bool = True) -> DataFrame:
    w = panel_window(key, order)
    return df.withColumn("ret_1", pct_change("close", 1, w, pad=pad))


def price_features(bars: DataFrame, key="symbol", order="date",
                   sharpe_eps: float = 1e-6, padded: str | None = None) -> DataFrame:
    """Add the 17 price/volume features of the reference to ``bars``.

    ``bars`` needs ``key, order, close, volume``.  Window lengths are those
    of the reference (21/63/252 rows for 1m/3m/12m, 50/200 for the SMAs).
    ``padded``: a column that holds the forward-filled close, which changes are
    taken of; without it the fill is a window here.
    """
    w = panel_window(key, order)
    changed, pad = padded or "close", padded is None
    base = bars.columns
    # stage 1: one-step inputs (daily return, k-row changes)
    s1 = bars.select(
        *base,
        pct_change(changed, 1, w, pad=pad).alias("_ret"),
        pct_change(changed, 21, w, pad=pad).alias("_chg21"),
        pct_change(changed, 5, w, pad=pad).alias("lag_ret_5"),
        pct_change(changed, 10, w, pad=pad).alias("lag_ret_10"),
        F.max("close").over(w.rowsBetween(-62, 0)).alias("_runmax63"),
    )
    # stage 2: trailing aggregates over the current row (not yet shifted)
    s2 = s1.select(
        *base, "_ret", "_chg21", "lag_ret_5", "lag_ret_10",
        roll(F.avg, "close", 50, w).alias("_sma50"),
        roll(F.avg, "close", 200, w).alias("_sma200"),
        roll(F.stddev_samp, "_ret", 63, w).alias("_std63"),
        roll(F.stddev_samp, "_ret", 252, w).alias("_std252"),
        roll(F.avg, "_ret", 63, w).alias("_mean63"),
        roll(F.avg, "volume", 63, w).alias("_avgv63"),
        (safe_div("close", "_runmax63") - F.lit(1.0)).alias("_dd"),
        rolling_skew("_ret", 63, w).alias("skew_3m"),
        rolling_kurt("_ret", 63, w).alias("kurt_3m"),
    )
    # stage 3: shift by one row (information available before the day opens)
    s3 = s2.select(
        *base, "lag_ret_5", "lag_ret_10", "skew_3m", "kurt_3m",
        F.col("_ret").alias("lag_ret_1"),
        shift("_chg21", 1, w).alias("return_1m"),
        shift("_sma50", 1, w).alias("sma_50"),
        shift("_sma200", 1, w).alias("sma_200"),
        shift("_std63", 1, w).alias("volatility_3m"),
        shift("_std252", 1, w).alias("volatility_12m"),
        shift("_mean63", 1, w).alias("_mean63_s"),
        shift("_avgv63", 1, w).alias("avg_volume_3m"),
        F.min("_dd").over(w.rowsBetween(-62, 0)).alias("_mdd"),
        shift("close", 1, w).alias("_close_s"),
    )
    s4 = s3.select(
        *base, "lag_ret_1", "lag_ret_5", "lag_ret_10", "skew_3m", "kurt_3m",
        "return_1m", "sma_50", "sma_200", "volatility_3m", "volatility_12m",
        "avg_volume_3m",
        shift("_mdd", 1, w).alias("max_drawdown_3m"),
        safe_div("sma_50", "sma_200").alias("sma_ratio"),
        (F.col("_mean63_s") / (F.col("volatility_3m") + F.lit(sharpe_eps))).alias("sharpe_3m"),
        safe_div("avg_volume_3m", "volatility_3m").alias("volume_volatility"),
        safe_div("_close_s", "sma_50").alias("price_vs_sma50"),
        safe_div("_close_s", "sma_200").alias("price_vs_sma200"),
    )
    return s4.select(*base, *PRICE_FEATURES)
