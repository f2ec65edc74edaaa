"""pandas-parity and edge tests for the positional window operators."""

import numpy as np
import pandas as pd
import pytest

from conftest import bars_frame, day_seq
from tickwise.functions.columns import panel_window, pct_change
from tickwise.operators import indicators as I
from tickwise.operators.price import price_features
from tickwise.operators.smoothing import ewm_mean


def _series(n, seed=1, level=100.0):
    rng = np.random.default_rng(seed)
    return level * np.exp(np.cumsum(rng.normal(0, 0.02, n)))


def _pdf(df, order="date"):
    return df.toPandas().sort_values(["symbol", order]).reset_index(drop=True)


def test_price_features_match_pandas(spark):
    n = 320
    closes = _series(n)
    vols = np.arange(1, n + 1, dtype=float) * 3.0
    df = bars_frame(spark, [("A", d, float(c), float(v)) for d, c, v in zip(day_seq(n), closes, vols)])
    got = _pdf(price_features(df))
    s = pd.Series(closes)
    r = s.pct_change()
    exp = pd.DataFrame({
        "return_1m": s.pct_change(21).shift(1),
        "sma_50": s.rolling(50).mean().shift(1),
        "sma_200": s.rolling(200).mean().shift(1),
        "volatility_3m": r.rolling(63).std().shift(1),
        "volatility_12m": r.rolling(252).std().shift(1),
        "sharpe_3m": r.rolling(63).mean().shift(1) / (r.rolling(63).std().shift(1) + 1e-6),
        "max_drawdown_3m": (s / s.rolling(63, min_periods=1).max() - 1.0)
        .rolling(63, min_periods=1).min().shift(1),
        "avg_volume_3m": pd.Series(vols).rolling(63).mean().shift(1),
        "lag_ret_1": s.pct_change(1), "lag_ret_5": s.pct_change(5),
        "lag_ret_10": s.pct_change(10),
        "skew_3m": r.rolling(63).skew(), "kurt_3m": r.rolling(63).kurt(),
    })
    exp["sma_ratio"] = exp.sma_50 / exp.sma_200
    exp["volume_volatility"] = exp.avg_volume_3m / exp.volatility_3m
    exp["price_vs_sma50"] = s.shift(1) / exp.sma_50
    exp["price_vs_sma200"] = s.shift(1) / exp.sma_200
    for c in exp.columns:
        a = got[c].astype(float).to_numpy()
        b = exp[c].to_numpy()
        assert np.array_equal(np.isnan(a), np.isnan(b)), c
        m = ~np.isnan(b)
        np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-12, err_msg=c)


def test_exact_window_first_volatility_row(spark):
    for n in (63, 64, 65):
        df = bars_frame(spark, [("A", d, float(c)) for d, c in zip(day_seq(n), _series(n))])
        got = _pdf(price_features(df))
        nn = got["volatility_3m"].notna().to_numpy()
        if n <= 64:
            assert not nn.any()
        else:
            assert nn.argmax() == 64 and nn.sum() == 1


def test_short_history_and_drawdown(spark):
    df = bars_frame(spark, [("A", d, float(c)) for d, c in zip(day_seq(10), _series(10))])
    got = _pdf(price_features(df))
    for c in ("sma_50", "volatility_3m", "skew_3m", "return_1m"):
        assert got[c].isna().all()
    assert got["max_drawdown_3m"].iloc[1:].notna().all()
    assert (got["max_drawdown_3m"].dropna() <= 0).all()


def test_flat_close(spark):
    df = bars_frame(spark, [("A", d, 100.0) for d in day_seq(300)])
    got = _pdf(I.technical_indicators(price_features(df)))
    assert got["skew_3m"].isna().all() and got["kurt_3m"].isna().all()
    assert (got["max_drawdown_3m"].dropna() == 0).all()
    assert (got["sharpe_3m"].dropna() == 0).all()
    assert got["volume_volatility"].isna().all()
    assert got["rsi"].isna().all()
    # flat closes inside a +-1 high/low band: %K is constant 50
    assert (got["stochastic_k"].dropna() == 50.0).all()


def test_rsi_rising_falling_and_obv(spark):
    up = bars_frame(spark, [("U", d, 10.0 + i, 5.0) for i, d in enumerate(day_seq(60))])
    dn = bars_frame(spark, [("D", d, 100.0 - i, 5.0) for i, d in enumerate(day_seq(60))])
    got = _pdf(I.obv(I.rsi(up.unionByName(dn))))
    u = got[got.symbol == "U"].reset_index(drop=True)
    d = got[got.symbol == "D"].reset_index(drop=True)
    assert (u["rsi"].dropna() == 100.0).all() and u["rsi"].notna().sum() == 60 - 21
    assert (d["rsi"].dropna() == 0.0).all()
    # OBV: running volume sum excluding row 0, shifted by one row
    exp = [np.nan, 0.0] + [5.0 * k for k in range(1, 59)]
    np.testing.assert_allclose(u["obv"].to_numpy(dtype=float)[1:], exp[1:])


@pytest.mark.parametrize("kw", [dict(com=20, adjust=True), dict(com=21, adjust=False),
                                dict(com=50, adjust=False), dict(span=15, adjust=False)])
def test_ewm_matches_pandas(spark, kw):
    n = 700
    x = _series(n, seed=3, level=1500.0)
    df = bars_frame(spark, [("A", d, float(c)) for d, c in zip(day_seq(n), x)])
    got = _pdf(ewm_mean(df, "close", "e", **kw))
    exp = pd.Series(x).ewm(**kw).mean()
    np.testing.assert_allclose(got["e"].to_numpy(), exp.to_numpy(), rtol=1e-11)


def test_ewm_long_series_blocked(spark):
    """12,000 rows at alpha = 0.125: the unblocked closed form overflows
    (0.875^-t is inf beyond ~5,300 rows); the blocked form stays exact."""
    n = 12000
    x = _series(n, seed=5, level=50.0)
    df = spark.createDataFrame(pd.DataFrame({"symbol": "A", "t": np.arange(n), "close": x}))
    got = ewm_mean(df, "close", "e", span=15, adjust=False, order="t").toPandas().sort_values("t")
    exp = pd.Series(x).ewm(span=15, adjust=False).mean()
    np.testing.assert_allclose(got["e"].to_numpy(), exp.to_numpy(), rtol=1e-9)
    got2 = ewm_mean(df, "close", "e", com=20, adjust=True, min_periods=21,
                    order="t").toPandas().sort_values("t")
    exp2 = pd.Series(x).ewm(com=20, min_periods=21).mean()
    np.testing.assert_allclose(got2["e"].to_numpy()[20:], exp2.to_numpy()[20:], rtol=1e-9)


def test_macd_bollinger_stochastic_match_pandas(spark):
    n = 400
    c = _series(n, seed=7)
    hi, lo = c * 1.01, c * 0.985
    df = bars_frame(spark, [("A", d, float(a), 1.0, float(h), float(l))
                            for d, a, h, l in zip(day_seq(n), c, hi, lo)])
    got = _pdf(I.stochastic(I.bollinger(I.macd(df))))
    s = pd.Series(c)
    es, el = s.ewm(com=21, adjust=False).mean(), s.ewm(com=50, adjust=False).mean()
    macd = es - el
    sig = macd.ewm(span=15, adjust=False).mean()
    lowest, highest = pd.Series(lo).rolling(21).min(), pd.Series(hi).rolling(21).max()
    k = (s - lowest) / (highest - lowest) * 100
    exp = {"macd": macd.shift(1), "macd_signal": sig.shift(1),
           "macd_indicator": (macd - sig).shift(1),
           "upper_bollinger": (s.rolling(20).mean() + 2 * s.rolling(20).std()).shift(1),
           "lower_bollinger": (s.rolling(20).mean() - 2 * s.rolling(20).std()).shift(1),
           "stochastic_k": k.shift(1), "stochastic_d": k.rolling(3).mean().shift(1)}
    for name, e in exp.items():
        a = got[name].astype(float).to_numpy()
        b = e.to_numpy()
        assert np.array_equal(np.isnan(a), np.isnan(b)), name
        m = ~np.isnan(b)
        np.testing.assert_allclose(a[m], b[m], rtol=1e-9, err_msg=name)


def test_unsorted_and_two_symbols(spark):
    n = 120
    a = [("A", d, float(c)) for d, c in zip(day_seq(n), _series(n, seed=1))]
    b = [("B", d, float(c)) for d, c in zip(day_seq(n), _series(n, seed=2))]
    mixed = a + b
    rng = np.random.default_rng(0)
    shuffled = [mixed[i] for i in rng.permutation(len(mixed))]
    both = _pdf(price_features(bars_frame(spark, shuffled)))
    alone = _pdf(price_features(bars_frame(spark, a)))
    pd.testing.assert_frame_equal(both[both.symbol == "A"].reset_index(drop=True), alone,
                                  check_exact=False, rtol=1e-12)


def test_gap_close_pad_vs_unpadded(spark):
    rows = [("A", d, c) for d, c in zip(day_seq(4), [1.0, None, 2.0, 2.0])]
    df = bars_frame(spark, rows)
    w = panel_window()
    got = _pdf(df.select("symbol", "date", pct_change("close", 1, w, pad=True).alias("p"),
                         pct_change("close", 1, w, pad=False).alias("u")))
    s = pd.Series([1.0, np.nan, 2.0, 2.0])
    np.testing.assert_allclose(got["p"].astype(float), s.ffill().pct_change(), equal_nan=True)
    np.testing.assert_allclose(got["u"].astype(float), s.pct_change(fill_method=None),
                               equal_nan=True)
