"""Properties from SURVEY section 5: bounds, causality (no look-ahead),
order independence and row preservation of the joins."""

import numpy as np
import pandas as pd
import pytest

from conftest import bars_frame, day_seq
from tickwise.functions.columns import round_cols
from tickwise.operators import indicators as I
from tickwise.operators.price import PRICE_FEATURES, price_features

TECH = list(I.TECHNICAL)


def _bars(spark, n, seed):
    rng = np.random.default_rng(seed)
    c = 50 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
    hi = c * (1 + rng.random(n) * 0.02)
    lo = c * (1 - rng.random(n) * 0.02)
    v = rng.integers(1, 100, n).astype(float)
    return bars_frame(spark, [("S", d, float(a), float(b), float(h), float(l))
                              for d, a, b, h, l in zip(day_seq(n), c, v, hi, lo)])


def _features(df):
    return I.technical_indicators(price_features(df))


@pytest.mark.parametrize("seed", [11, 12])
def test_bounds(spark, seed):
    out = _features(_bars(spark, 400, seed)).toPandas()
    rsi = out["rsi"].dropna()
    assert ((rsi >= 0) & (rsi <= 100)).all()
    assert (out["max_drawdown_3m"].dropna() <= 1e-15).all()
    both = out[["lower_bollinger", "upper_bollinger"]].dropna()
    assert (both.lower_bollinger <= both.upper_bollinger).all()
    k = out["stochastic_k"].dropna()
    assert ((k >= 0) & (k <= 100)).all()


def test_no_look_ahead(spark):
    """Appending future rows never changes a feature at an earlier date."""
    full = _bars(spark, 330, 5)
    short = full.orderBy("date").limit(300)
    cols = ["symbol", "date", *PRICE_FEATURES, *TECH]
    a = round_cols(_features(short).select(*cols), 9).toPandas().sort_values("date")
    b = round_cols(_features(full).select(*cols), 9).toPandas().sort_values("date").head(300)
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_joins_preserve_rows(spark, sf_small):
    from tickwise.plans import catalog as C
    from tickwise.sources import bars as B
    bars = B.bars_daily(spark, sf_small)
    n = bars.count()
    from tickwise.operators import macro as M
    from tickwise.sources import macro as SM
    macro = M.build_macro(SM.macro_daily(spark, sf_small), SM.macro_monthly(spark, sf_small))
    assert bars.join(macro, "date", "left").count() == n
    from tickwise.operators import fundamentals as FU
    from tickwise.sources import statements as ST
    p = C._parsed(spark, sf_small)
    asof = FU.asof_fundamentals(bars.select("symbol", "date"), FU.fundamentals_long(p),
                                ST.report_dates(p), C.ALL_ITEMS, trim=False)
    assert asof.count() == n
