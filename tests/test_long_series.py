"""Series and groups of any length: equal to the plain windows and aggregates,
with slices and blocks far shorter than a series."""

import datetime as dt
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwise.functions.columns import panel_window
from tickwise.functions.selection import exact_percentile
from tickwise.functions.slices import POS, ewm_scan, numbered, segmented_scan, sliced
from tickwise.operators import indicators as I
from tickwise.operators import labels as L
from tickwise.operators import long_series as LS
from tickwise.operators import price as P
from tickwise.operators.asof import asof_join


@pytest.fixture()
def many_slices(spark):
    """Keeps the range slices apart, however small they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def bars(spark):
    """One long symbol with missing closes, two short ones, and one of a single row."""
    rng, rows = random.Random(5), []
    for symbol, n in (("long", 1500), ("mid", 300), ("tiny", 3), ("one", 1)):
        close = 100.0
        for i in range(n):
            close = round(max(1.0, close + rng.uniform(-2, 2)), 2)
            missing = i == 0 and symbol == "mid" or symbol == "long" and (i % 17 == 3 or 700 <= i < 730)
            rows.append((symbol, dt.date(2000, 1, 1) + dt.timedelta(days=i), close, close + rng.random(),
                         close - rng.random(), None if missing else close, float(rng.randint(1, 50))))
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, "
                                       "close double, volume double").cache()


def same(own, plain, cols, tolerance=1e-9):
    a, b = (df.select("symbol", "date", *cols).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
            for df in (own, plain))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=tolerance, atol=1e-7)


def test_numbered(many_slices, bars):
    rows = numbered(bars, "symbol", "date", slices=7).toPandas().sort_values(["symbol", "date"])
    assert rows["_slice"].nunique() > 3
    assert (rows.groupby("symbol").cumcount() == rows[POS]).all()


@pytest.mark.parametrize("without", [False, True])
def test_segmented_scan(many_slices, bars, without):
    cut = sliced(bars, "symbol", "date", 6)
    kinds = {"s": ("sum", "close", without), "n": ("count", "close", without), "hi": ("max", "close", without),
             "lo": ("min", "close", without), "at": ("last", "close", without)}
    own = segmented_scan(cut, kinds, "symbol", "date", written=True)
    w = panel_window().rowsBetween(Window.unboundedPreceding, -1 if without else 0)
    plain = bars.withColumns({"s": F.sum("close").over(w), "n": F.count("close").over(w), "hi": F.max("close").over(w),
                              "lo": F.min("close").over(w), "at": F.last("close", ignorenulls=True).over(w)})
    own = own.withColumn("n", F.coalesce("n", F.lit(0)))
    same(own, plain, list(kinds))


def test_scan_of_null_keys(many_slices):
    rows = many_slices.createDataFrame([(None, i, i) for i in range(20)] + [("a", i, None) for i in range(9)],
                                       "k string, t int, v int")
    out = segmented_scan(sliced(rows, "k", "t", 5), {"s": ("sum", "v")}, "k", "t").toPandas()
    assert out[out.k.isna()].sort_values("t").s.tolist() == np.arange(20).cumsum().tolist()
    assert out[out.k == "a"].s.isna().all()


def test_price_features_by_halo(many_slices, bars):
    same(LS.long_price_features(bars, block_rows=260), P.price_features(bars), P.PRICE_FEATURES)


def test_no_window_over_a_whole_symbol(many_slices, bars):
    """Windows of rows go by slice or block; those by symbol alone see one row per slice."""
    for df in (LS.long_price_features(bars), LS.long_max_drawdown(bars, 50), LS.long_stochastic(bars, 50)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for line in (x for x in plan.splitlines() if "Window [" in x):
            own = re.findall(r"\], \[([^\]]*)\], \[[^\]]*\]$", line.strip())
            by = own[0] if own else line
            assert "_block" in by or "_slice" in by or "_c_" in line, line


@pytest.mark.parametrize("k", [1, 2, 63, 700])
def test_max_drawdown_by_blocks(many_slices, bars, k):
    w = panel_window()
    top = F.max("close").over(w.rowsBetween(-(k - 1), 0))
    plain = bars.withColumn("dd", F.try_divide(F.col("close"), top) - 1)
    plain = plain.withColumn("low", F.min("dd").over(w.rowsBetween(-(k - 1), 0)))
    plain = plain.withColumn("max_drawdown", F.lag("low", 1).over(w))
    same(LS.long_max_drawdown(bars, k, block_rows=2 * k + 5), plain, ["max_drawdown"])


def test_extremes_of_ten_thousand_rows(many_slices):
    """Against pandas, where a plain frame would look at k rows for each row."""
    rng = np.random.default_rng(1)
    close = 100 + rng.normal(size=25_000).cumsum() * 0.01
    frame = pd.DataFrame({"symbol": "s", "date": np.arange(25_000), "close": close})
    own = LS.long_max_drawdown(many_slices.createDataFrame(frame), 10_000).toPandas().sort_values("date")
    s = pd.Series(close)
    dd = s / s.rolling(10_000, min_periods=1).max() - 1
    np.testing.assert_allclose(own.max_drawdown, dd.rolling(10_000, min_periods=1).min().shift(1), rtol=1e-12)


@pytest.mark.parametrize("k", [21, 400])
def test_stochastic_by_blocks(many_slices, bars, k):
    same(LS.long_stochastic(bars, k, block_rows=k + 10), I.stochastic(bars, k), ["stochastic_k", "stochastic_d"])


def test_scans_equal_the_indicators(many_slices, bars):
    filled = bars.withColumn("close", F.last("close", ignorenulls=True).over(panel_window())).where("close is not null")
    plain = I.obv(I.macd(I.rsi(filled))).withColumn("close_filled", F.col("close"))
    own = LS.long_scans(bars)
    assert own.count() == bars.count() and own.where("symbol = 'mid' and close_filled is null").count() == 1
    same(own.where("close_filled is not null"), plain, LS.SCANNED)


def test_ewm_over_blocks(many_slices):
    """Blocks of 300 rows and of one row; nulls; against pandas."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=2000)
    x[rng.random(2000) < 0.2] = np.nan
    frame = pd.DataFrame({"symbol": "s", "date": np.arange(2000), "x": x, "y": np.nan_to_num(x)})
    df = many_slices.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for alpha in (0.63, 0.05, 1.0):
        rows = ewm_scan(numbered(df, "symbol", "date", 5), {"a": "x"}, alpha, "symbol", min_periods=10)
        rows = ewm_scan(rows, {"b": "y"}, alpha, "symbol", adjust=False).toPandas().sort_values("date")
        if alpha < 1:
            np.testing.assert_allclose(rows.a, frame.x.ewm(alpha=alpha, min_periods=10).mean(), rtol=1e-9)
        np.testing.assert_allclose(rows.b, frame.y.ewm(alpha=alpha, adjust=False).mean(), rtol=1e-9, atol=1e-12)
    with pytest.raises(Exception, match="fill it before"):
        ewm_scan(numbered(df, "symbol", "date"), {"b": "x"}, 0.1, "symbol", adjust=False).collect()


def test_exact_percentile(spark):
    """Ties, nulls, huge spreads and tiny groups, each narrowed until 20 rows are left."""
    rng = random.Random(7)
    groups = {"even": [rng.random() for _ in range(3000)], "ties": [float(rng.randint(0, 3)) for _ in range(2000)],
              "one_value": [5.0] * 500, "spread": [2.0 ** rng.randint(-900, 900) for _ in range(2500)],
              "half": [1.0] * 800 + [rng.random() for _ in range(800)], "two": [3.0, 4.0], "none": [None] * 40,
              "negative": [-rng.paretovariate(0.5) for _ in range(1500)], "nan": [float("nan"), 1.0, None], None: [1.0, 2.0, 4.0]}
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.0, 0.37, 0.6, 1.0):
        own = {r.g: r.p for r in exact_percentile(df, ["g"], "x", q, "p", limit=20).collect()}
        assert own.keys() == groups.keys()
        plain = df.where("not isnan(x)").groupBy("g").agg(F.percentile("x", F.lit(q)).alias("p")).collect()
        assert {r.g: r.p for r in plain} == own
    assert exact_percentile(df.limit(0), ["g"], "x", 0.5).count() == 0


def test_quantile_label(many_slices, bars):
    plain = L.yearly_quantile_label(bars, keep_threshold=True)
    own = LS.long_quantile_label(bars, limit=30, block_rows=70)
    same(own, plain, ["target_3m_raw", "threshold", "target_3m"], tolerance=0)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(many_slices, strict):
    rng = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    time = lambda: t0 + dt.timedelta(minutes=rng.randrange(3000))
    points = [(s, time(), i) for i in range(600) for s in "ab"] + [("c", time(), 1), ("a", None, 2), (None, time(), 3)]
    reports = [(s, time(), float(i)) for i in range(120) for s in "ab"] + [("a", None, 1.0), ("d", time(), 2.0)]
    reports += [(s, t, v + 0.5) for s, t, v in reports[:40] if t]  # two at one time
    own = asof_join(many_slices.createDataFrame(points, "s string, at timestamp_ntz, n int"),
                    many_slices.createDataFrame(reports, "s string, at timestamp_ntz, v double")
                    .withColumnRenamed("at", "known"), "s", "at", "known", strict)

    def last(s, t):
        held = [(k, v) for r, k, v in reports if r == s and k and t and (k < t or k == t and not strict)]
        return max(held, default=(None, None))

    truth = [(s, t, n, *last(s, t)) for s, t, n in points]
    assert sorted(map(tuple, own.collect()), key=str) == sorted(truth, key=str)
