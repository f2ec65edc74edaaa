"""Exponentially weighted means without a recursive operator.

pandas' ``ewm(...).mean()`` is a first-order recurrence.  Spark SQL has no
recursive window, but the recurrence is a quotient or a product of running
sums, i.e. of ordinary window aggregates inside codegen.  NULL values are
skipped as pandas skips them (``ignore_na=False``): a NULL adds no weight, the
weights of earlier values decay over its row all the same, and the last mean
is carried to its row.  With ``r = 1 - alpha``:

* ``adjust=True``: ``y_t = sum x_i r^(t-i) / sum r^(t-i)`` over the non-null
  ``i <= t``;
* ``adjust=False``: ``y = c y' + (1 - c) x`` from one non-null value to the
  next one ``d`` rows on, with ``c = r^d / (r^d + alpha)`` (``c = r`` without
  a gap), the first value having weight one.

Both need growing factors that overflow a double after a few thousand rows, so
rows are cut into blocks over which the weights fall by ``e^-300`` at most.  Inside
a block the sums are local; the value at the end of the previous block is
carried in with its decay.  Anything older is weighted by at most ``e^-300``
relative to that, far below double precision, so the blocked form is exact in
double arithmetic for series of any length.  The block windows partition by
``(key, block)``, which the hash partitioning on ``key`` already satisfies.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import panel_window

LOG_SPAN = 300.0  # block length bound: r^-B <= e^LOG_SPAN


def alpha_of(com: float | None = None, span: float | None = None,
             alpha: float | None = None) -> float:
    """pandas' parametrisations: ``com`` -> 1/(1+com), ``span`` -> 2/(span+1)."""
    given = [v is not None for v in (com, span, alpha)]
    if sum(given) != 1:
        raise ValueError("give exactly one of com, span, alpha")
    if com is not None:
        return 1.0 / (1.0 + com)
    if span is not None:
        return 2.0 / (span + 1.0)
    return float(alpha)


def block_rows(alpha: float) -> int:
    r = 1.0 - alpha
    if r <= 0.0:
        return 1 << 30
    return max(1, int(LOG_SPAN / -math.log(r)))


def ewm_mean(df: DataFrame, value: str, out: str, *, com: float | None = None,
             span: float | None = None, alpha: float | None = None,
             adjust: bool = True, min_periods: int = 0, key="symbol",
             order="date") -> DataFrame:
    """Add column ``out`` = ``value.ewm(...).mean()`` per ``key`` by ``order``."""
    a = alpha_of(com, span, alpha)
    w = panel_window(key, order)
    keys = [key] if isinstance(key, str) else list(key)
    t, blk, loc = f"_{out}_t", f"_{out}_blk", f"_{out}_loc"
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    x, seen = F.col(value), F.col(value).isNotNull()
    d = df.withColumns({t: F.row_number().over(w) - 1})
    wb = (Window.partitionBy(*keys, blk).orderBy(order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if adjust:
        r, rows = 1.0 - a, block_rows(a)
        d = d.withColumns({blk: F.floor(F.col(t) / F.lit(rows)),
                           loc: F.col(t) - F.floor(F.col(t) / F.lit(rows)) * F.lit(rows)})
        decay, grow = F.pow(F.lit(r), F.col(loc)), F.pow(F.lit(r), -F.col(loc))
        carry = F.pow(F.lit(r), F.col(loc) + 1)
        num, den = f"_{out}_nl", f"_{out}_dl"
        d = d.withColumns({num: decay * F.coalesce(F.sum(x * grow).over(wb), F.lit(0.0)),
                           den: decay * F.coalesce(F.sum(F.when(seen, grow)).over(wb), F.lit(0.0))})
        is_end = F.col(loc) == F.lit(rows - 1)

        def whole(c):
            end = F.last(F.when(is_end, F.col(c)), ignorenulls=True).over(before)
            return F.col(c) + carry * F.coalesce(end, F.lit(0.0))
        val, tmp = F.try_divide(whole(num), whole(den)), [num, den]
    else:
        r, log_r = 1.0 - a, math.log(1.0 - a) if a < 1.0 else -math.inf
        mend, lift, part, end = f"_{out}_g", f"_{out}_lg", f"_{out}_yl", f"_{out}_e"
        gap = F.col(t) - F.last(F.when(seen, F.col(t)), ignorenulls=True).over(before)
        # What a gap leaves of the earlier mean beyond r^rows; one without a gap.
        d = d.withColumns({mend: F.when(seen & (gap > 1), F.lit(1.0) / (F.pow(F.lit(r), gap) + F.lit(a)))
                           .otherwise(F.lit(1.0)), loc: gap})
        fall = F.sum(F.when(seen, F.col(loc) * F.lit(log_r) + F.log(mend))).over(so_far)
        d = d.withColumns({blk: F.floor(-F.coalesce(fall, F.lit(0.0)) / F.lit(LOG_SPAN)),
                           part: F.when(F.col(loc).isNull(), F.lit(1.0)).otherwise(F.lit(a) * F.col(mend))})
        d = d.withColumns({loc: F.col(t) - F.min(t).over(wb), lift: F.sum(F.log(mend)).over(wb)})

        def factor(rows):
            return F.when(F.col(lift) == 0, F.pow(F.lit(r), rows)).otherwise(
                F.exp(rows * F.lit(log_r) + F.col(lift)))
        local = factor(F.col(loc))
        d = d.withColumns({part: local * F.coalesce(F.sum(F.col(part) * x / local).over(wb), F.lit(0.0))})
        is_end = F.lead(blk, 1).over(w) != F.col(blk)
        d = d.withColumns({end: F.last(F.when(is_end, F.struct(part, t)), ignorenulls=True).over(before)})
        carried = F.col(end).getField(part) * factor(F.col(t) - F.col(end).getField(t))
        d = d.withColumns({part: F.when(seen, F.col(part) + F.coalesce(carried, F.lit(0.0)))})
        val, tmp = F.last(part, ignorenulls=True).over(so_far), [mend, lift, part, end]
    if min_periods > 1:
        val = F.when(F.count(x).over(so_far) >= F.lit(min_periods), val)
    return d.withColumns({out: val}).drop(t, blk, loc, *tmp)
