"""Column-level building blocks for keyed time series.

All helpers return Spark ``Column`` expressions built from SQL built-ins,
so they stay inside whole-stage codegen.  Missing values are NULL only:
every division goes through ``try_divide`` (ANSI mode raises on ``x/0``)
and comparisons that pandas treats as False on a missing operand are
wrapped in ``coalesce``.

Offsets count rows (trading days), never calendar days.  ``roll`` gates a
sliding frame on the number of non-null inputs, because a Spark frame
returns a value over a partial frame while a pandas ``rolling(k)`` returns
missing until ``min_periods`` values are present.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

SYMBOL = "symbol"
DATE = "date"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def panel_window(key: str | list[str] = SYMBOL, order: str = DATE) -> WindowSpec:
    """The one window every positional operator uses: per key, by time."""
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def frame(w: WindowSpec, k: int) -> WindowSpec:
    """Trailing frame of ``k`` rows ending at the current row."""
    return w.rowsBetween(-(k - 1), Window.currentRow)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def safe_div(a, b) -> Column:
    """Division that yields NULL (not an error, not inf) on a zero or NULL divisor."""
    return F.try_divide(col(a), col(b))


def shift(c, k: int, w: WindowSpec) -> Column:
    """pandas ``shift(k)``: positive k looks back, negative k looks ahead."""
    return F.lag(col(c), k).over(w) if k >= 0 else F.lead(col(c), -k).over(w)


def finite(c) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    v = F.col(c) if isinstance(c, str) else c
    v = v.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def ffill(c, w: WindowSpec) -> Column:
    """Forward fill: last non-null value up to and including this row."""
    return F.last(col(c), ignorenulls=True).over(running(w))


def pct_change(c, k: int, w: WindowSpec, pad: bool = False) -> Column:
    """``x[t] / x[t-k] - 1``.

    ``pad=True`` reproduces pandas' default fill (forward fill before the
    division); ``pad=False`` is ``fill_method=None``.  Identical when the
    input has no interior NULLs.
    """
    x = ffill(c, w) if pad else col(c)
    return safe_div(x, F.lag(x, k).over(w)) - F.lit(1.0)


def diff(c, k: int, w: WindowSpec) -> Column:
    return col(c) - F.lag(col(c), k).over(w)


def roll(agg, c, k: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    """Trailing ``k``-row aggregate, NULL until ``min_periods`` non-null inputs.

    ``agg`` is a pyspark.sql.functions aggregate such as ``F.avg``.
    """
    mp = k if min_periods is None else min_periods
    fr = frame(w, k)
    value = agg(col(c)).over(fr)
    if mp <= 1 and agg in (F.max, F.min, F.avg, F.mean, F.sum):
        return value
    return F.when(F.count(col(c)).over(fr) >= F.lit(mp), value)


def rolling_skew(c, k: int, w: WindowSpec) -> Column:
    """Bias-corrected sample skewness over ``k`` rows (pandas ``rolling.skew``).

    Spark's ``skewness`` is the population g1; the adjusted estimator is
    ``g1 * sqrt(n(n-1)) / (n-2)``.  NULL on a flat window.
    """
    fr = frame(w, k)
    n = F.count(col(c)).over(fr).cast("double")
    g1 = F.skewness(col(c)).over(fr)
    return F.when(n >= F.lit(max(k, 3)), g1 * F.sqrt(n * (n - 1)) / (n - 2))


def rolling_kurt(c, k: int, w: WindowSpec) -> Column:
    """Bias-corrected excess kurtosis over ``k`` rows (pandas ``rolling.kurt``).

    ``(n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)`` with Spark's population g2.
    """
    fr = frame(w, k)
    n = F.count(col(c)).over(fr).cast("double")
    g2 = F.kurtosis(col(c)).over(fr)
    return F.when(n >= F.lit(max(k, 4)),
                  (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def zscore(c, k: int, w: WindowSpec, eps: float = 1e-9) -> Column:
    """``(x - mean_k) / (std_k + eps)`` with sample std and a full-window gate."""
    return (col(c) - roll(F.avg, c, k, w)) / (roll(F.stddev_samp, c, k, w) + F.lit(eps))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where a NULL comparison counts as False (pandas)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def det_round(c, digits: int = 6, sig: int | None = 9) -> Column:
    """Round half up to ``digits`` decimals, or to ``sig`` significant digits
    once ``|x| >= 10^(sig - digits - 1)``:
    ``floor(x * 10^d + 0.5) / 10^d``.

    Built only from IEEE multiply/add/floor/divide (and an exact power of
    ten), so any engine that follows IEEE 754 returns the same bits; the
    magnitude rule keeps the rounding unit above the last-bit noise of sums
    taken in a different order, and ``round()`` implementations differ on
    values that sit exactly on a half (prices divided by 32).
    """
    x = col(c)
    if sig is None:
        scale = F.lit(float(10 ** digits))
        return F.floor(x * scale + F.lit(0.5)).cast("double") / scale
    ax = F.abs(x)
    big = float(10 ** (sig - digits - 1))
    d = F.when(ax >= F.lit(big),
               F.least(F.lit(digits), F.lit(sig - 1) - F.floor(F.log10(ax)))).otherwise(F.lit(digits))
    scale = F.pow(F.lit(10.0), d)
    return F.floor(x * scale + F.lit(0.5)).cast("double") / scale


def round_cols(df, digits: int = 6, skip: tuple = ()):
    """Round every double column (for engine-independent comparisons)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in skip:
            out.append(det_round(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
