"""Macro features and the macro calendar.

Series arrive in long form ``(series_id, date, value)`` and every window is
partitioned by ``series_id``, so many series spread over tasks.  Each
builder returns ``(date, <features>)`` with incomplete rows dropped, as the
reference drops them before aligning the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import diff, panel_window, pct_change, roll, zscore
from ..functions.frames import densify_daily, ffill_by_time
from ..session import materialize

VIX_COLS = ("vix", "vix_change_20d", "vix_z20")
CPI_COLS = ("cpi", "cpi_yoy", "cpi_mom", "cpi_yoy_trend", "cpi_yoy_z")
YIELD_COLS = ("yield_10y", "yield_10y_change", "yield_10y_roc", "yield_10y_z")
MACRO_COLS = VIX_COLS + CPI_COLS + YIELD_COLS


def _one(series: DataFrame, series_id: str | None) -> DataFrame:
    return series if series_id is None else series.where(F.col("series_id") == series_id)


def vix_features(series: DataFrame, series_id: str | None = "VIX", change_rows: int = 20,
                 z_rows: int = 20) -> DataFrame:
    """Level, 20-row change (no fill) and 20-row z-score (eps 1e-9)."""
    w = panel_window("series_id", "date")
    s = _one(series, series_id)
    out = s.select(
        "date",
        F.col("value").alias("vix"),
        pct_change("value", change_rows, w, pad=False).alias("vix_change_20d"),
        zscore("value", z_rows, w, eps=1e-9).alias("vix_z20"),
    )
    return out.dropna("any")


def yield_features(series: DataFrame, series_id: str | None = "TNX", scale: float = 10.0,
                   z_rows: int = 60) -> DataFrame:
    """Quote / 10 (P2), one-row difference, one-row change, 60-row z-score."""
    w = panel_window("series_id", "date")
    s = _one(series, series_id).withColumn("yield_10y", F.col("value") / F.lit(scale))
    out = s.select(
        "date", "yield_10y",
        diff("yield_10y", 1, w).alias("yield_10y_change"),
        pct_change("yield_10y", 1, w, pad=True).alias("yield_10y_roc"),
        zscore("yield_10y", z_rows, w, eps=1e-9).alias("yield_10y_z"),
    )
    return out.dropna("any")


def cpi_features(monthly: DataFrame, series_id: str | None = "CPI",
                 release_lag_days: int = 0) -> DataFrame:
    """Monthly level, YoY (12 rows) and MoM changes, 6-month YoY trend and a
    24-month YoY z-score -- all on monthly rows, before densifying to days.
    ``release_lag_days`` moves each value to its publication date (0 keeps
    the reference's month-start dating)."""
    w = panel_window("series_id", "date")
    s = _one(monthly, series_id)
    m = s.select("series_id", "date", F.col("value").alias("cpi"),
                 pct_change("value", 12, w, pad=False).alias("cpi_yoy"),
                 pct_change("value", 1, w, pad=False).alias("cpi_mom"))
    m = m.select("series_id", "date", "cpi", "cpi_yoy", "cpi_mom",
                 roll(F.avg, "cpi_yoy", 6, w).alias("cpi_yoy_trend"),
                 zscore("cpi_yoy", 24, w, eps=1e-9).alias("cpi_yoy_z"))
    daily = densify_daily(m, "date", key="series_id")
    if release_lag_days:
        daily = daily.withColumn("date", F.date_add("date", release_lag_days))
    return daily.select("date", *CPI_COLS).dropna("any")


def macro_calendar(*frames: DataFrame) -> DataFrame:
    """Outer alignment of macro frames on date, then forward fill per
    column along the union calendar (W14).  Missing frames (None) are
    skipped (S8); with no frame at all the result is an empty calendar."""
    present = [f for f in frames if f is not None]
    if not present:
        spark = SparkSession.active()
        return spark.createDataFrame([], ", ".join(["date date", *(f"{c} double" for c in MACRO_COLS)]))
    out = present[0]
    for f in present[1:]:
        out = out.join(f, "date", "full_outer")
    cols = [c for c in out.columns if c != "date"]
    return ffill_by_time(materialize(out), cols, "date")


def build_macro(daily: DataFrame | None, monthly: DataFrame | None) -> DataFrame:
    """The macro table from long daily + monthly series.  A daily table without
    the VIX series is an error, one without yields is not: their columns are
    then missing throughout."""
    if daily is not None and daily.where(F.col("series_id") == "VIX").isEmpty():
        raise ValueError("the daily series hold no VIX rows")
    vix = vix_features(daily) if daily is not None else None
    cpi = cpi_features(monthly) if monthly is not None else None
    tnx = yield_features(daily) if daily is not None else None
    return macro_calendar(vix, cpi, tnx)
