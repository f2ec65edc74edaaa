"""Readers, missing values and the rules for missing sources."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, day_seq
from tickwise.operators import macro as M
from tickwise.operators.smoothing import ewm_mean
from tickwise.plans import catalog
from tickwise.plans.panel import feature_panel
from tickwise.session import ensure_checkpoint_dir
from tickwise.sources import bars as B
from tickwise.sources import macro as SM
from tickwise.sources import statements as ST

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("how", [dict(com=2, adjust=False), dict(com=2, adjust=True), dict(span=15, adjust=False),
                                 dict(com=20, adjust=True, min_periods=21), dict(com=50, adjust=False)])
def test_ewm_skips_nulls_like_pandas(spark, how):
    rng = np.random.default_rng(0)
    series = {"gap": [1, 2, None, 4, 5], "none": [None] * 5, "lead": [None, None, 3, None, 4]}
    for k, (n, share) in enumerate([(2_000, 0), (2_000, .5), (9_000, .97)]):
        x = rng.normal(100, 10, n)
        series[str(k)] = [None if m else float(v) for v, m in zip(x, rng.random(n) < share)]
    df = spark.createDataFrame([(s, i, None if v is None else float(v)) for s, x in series.items() for i, v in enumerate(x)],
                               "symbol string, date int, v double")
    out = ewm_mean(df, "v", "o", **how).toPandas().sort_values(["symbol", "date"])
    for s, x in series.items():
        expected = pd.Series(x, dtype=float).ewm(**how).mean().to_numpy()
        np.testing.assert_allclose(out[out.symbol == s].o.to_numpy(dtype=float), expected, rtol=1e-11)


def test_trades_without_finite_price_are_left_out(spark):
    rows = [("A", 1, 10.0, 1.0), ("A", 2, NAN, 1.0), ("A", 3, INF, 1.0), ("A", 4, 12.0, NAN), ("A", 5, None, 5.0)]
    trades = spark.createDataFrame(rows, "s string, k int, px double, q double")
    bar = B.build_bars(trades, F.col("s"), F.lit("2020-01-01").cast("date"), F.col("px"), F.col("q"), [F.col("k")]).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (10.0, 12.0, 10.0, 12.0, 1.0)


def test_written_bars_are_hashed_and_the_same(spark, sf_small, monkeypatch):
    """The panel's bars need no sort of all trades; ties, NULL keys and orders come out alike."""
    rows = [(s, d, k, j, float(p), 1.0) for s, d, k, j, p in (
        ("A", 1, 5, 2, 10), ("A", 1, 5, 1, 11), ("A", 1, 5, 1, 9), ("A", 1, 9, 1, 12), ("A", 1, 9, 3, 8), ("A", 1, 7, 0, 99),
        ("A", 2, None, 4, 3), ("A", 2, 1, 0, 4), ("A", 2, None, 2, 5), ("B", 1, None, None, 6), ("B", 1, None, 1, 7),
        (None, 1, 3, 1, 2), (None, 1, 2, 1, 1), ("B", None, 1, 1, 1), ("C", 1, 1, 1, NAN), ("C", 1, 2, 1, 5), ("C", 3, 2, 1, INF))]
    trades = spark.createDataFrame(rows, "s string, d int, k int, j int, px double, q double")
    plain, hashed = (B.build_bars(trades, F.col("s"), F.col("d"), F.col("px"), F.col("q"), [F.col("k"), F.col("j"), F.col("px")], written=w)
                     for w in (False, True))
    assert hashed.columns == plain.columns and plain.count() == hashed.count() == 6
    assert plain.exceptAll(hashed).count() == 0
    bar = hashed.where("symbol = 'A' and date = 1").first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (9.0, 99.0, 8.0, 8.0, 6.0)

    plans, write = [], B.materialize
    monkeypatch.setattr(B, "materialize", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df))[1])
    monkeypatch.setattr(catalog.PN, "feature_panel", lambda bars, *_, **__: bars)
    bars = catalog.build_panel(spark, sf_small)
    assert "SortAggregate" not in plans[0] and plans[0].count("HashAggregate") >= 2
    assert bars.exceptAll(B.bars_daily(spark, sf_small)).count() == 0 and bars.count() == B.bars_daily(spark, sf_small).count()


def test_read_bars_pushes_filters(spark, tmp_path):
    rows = [("A", "2020-01-01", 1.0), ("A", "2020-01-02", NAN), ("B", "2020-01-02", 3.0), ("C", "2020-01-02", 4.0), ("A", "2020-01-04", 5.0)]
    bars_frame(spark, rows).unionByName(bars_frame(spark, [(None, "2020-01-02", 1.0)])).write.parquet(str(tmp_path / "bars"))
    got = B.read_bars(spark, str(tmp_path / "bars"), symbols=["A", "B"], start="2020-01-02", end="2020-01-03")
    assert [(r.symbol, r.close) for r in got.orderBy("symbol").collect()] == [("A", None), ("B", 3.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(symbol" in plan and "GreaterThanOrEqual(date" in plan


def test_statement_files_and_their_audit(spark, tmp_path):
    good = {"quarterlyReports": [{"fiscalDateEnding": "2020-03-31", "totalRevenue": "5"}]}
    files = {"BRK_B_income": json.dumps(good), "A_income": "{broken", "A_balance": "{}", "A_cashflow": json.dumps({"quarterlyReports": [{"x": "1"}]})}
    for name, body in files.items():
        (tmp_path / f"{name}.json").write_text(body)
    docs = ST.read_statements(spark, str(tmp_path))
    assert {(r.symbol, r.statement) for r in docs.collect()} == {("BRK_B", "income"), ("A", "income"), ("A", "balance"), ("A", "cashflow")}
    bad = {(r.symbol, r.statement): r.reason for r in ST.unreadable_statements(docs).collect()}
    assert bad == {("A", "income"): "corrupt", ("A", "balance"): "no reports", ("A", "cashflow"): "no dated report"}
    assert [r.value for r in ST.parse_statements(docs).collect()] == [5.0]


def test_missing_macro_sources(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), 20.0 + i % 7) for i in range(100)]
    vix = spark.createDataFrame([("VIX", d, v) for d, v in days], "series_id string, date date, value double")
    assert M.macro_calendar().columns == ["date", *M.MACRO_COLS] and M.macro_calendar().count() == 0
    with pytest.raises(ValueError):
        M.build_macro(vix.where("series_id = 'TNX'"), None)
    assert M.build_macro(vix, None).where("vix is not null and yield_10y is null").count() > 0


def test_panel_fills_the_bars_before_the_indicators(spark):
    """A missing bar takes the values of the bar before it, as in pandas."""
    n = 140
    rng = np.random.default_rng(1)
    close = 100 * np.exp(np.cumsum(rng.normal(0, .02, n)))
    gap = [i in (60, 61, 90) for i in range(n)]
    rows = [(s, d, None if g else float(c * k), 50.0 + i) for s, k in (("A", 1), ("B", 2))
            for i, (d, c, g) in enumerate(zip(day_seq(n), close, gap))]
    bars = bars_frame(spark, rows).withColumn("volume", F.when(F.col("close").isNotNull(), F.col("volume")))
    got = feature_panel(bars, benchmarks=["B"]).where("symbol = 'A'").toPandas().sort_values("date")
    c = pd.Series([np.nan if g else v for g, v in zip(gap, close)]).ffill()
    v = pd.Series([np.nan if g else 50.0 + i for i, g in enumerate(gap)]).ffill()
    hi, lo = c + 1, c - 1
    up, down = c.diff().clip(lower=0).fillna(0), (-c.diff()).clip(lower=0).fillna(0)
    mean = lambda x: x.ewm(com=20, min_periods=21).mean()
    expected = {"rsi": 100 - 100 / (1 + mean(up) / mean(down)),
                "macd": c.ewm(com=21, adjust=False).mean() - c.ewm(com=50, adjust=False).mean(),
                "upper_bollinger": c.rolling(20).mean() + 2 * c.rolling(20).std(),
                "stochastic_k": (c - lo.rolling(21).min()) / (hi.rolling(21).max() - lo.rolling(21).min()) * 100,
                "obv": (np.sign(c.diff().fillna(0)) * v).cumsum()}
    for name, x in expected.items():
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), x.shift(1).to_numpy(), rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["rs_b"].to_numpy(dtype=float)[1:], 0, atol=1e-9)


def test_benchmarks_of_the_same_bars_need_one_scan(spark, sf_small):
    for name in ("relative_strength", "forward_fill"):
        plan = catalog.QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[-1]
        assert final.count("Scan parquet") == 4, name  # line items, supplier, nation, region


def test_macro_series_agree_with_their_own_scans(spark, sf_small):
    daily, monthly = SM.macro_series(spark, sf_small)
    for one, two in ((daily, SM.macro_daily(spark, sf_small)), (monthly, SM.macro_monthly(spark, sf_small))):
        pair = one.join(two.withColumnRenamed("value", "other"), ["series_id", "date"], "full_outer")
        assert pair.where("value is null or other is null or abs(value - other) > 1e-9").count() == 0


def test_a_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(type("Session", (), {"sparkContext": Context()})())
