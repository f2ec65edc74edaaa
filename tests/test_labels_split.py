"""Labels, split, folds, weights, class balance."""

import datetime as dt

import numpy as np
import pandas as pd

from conftest import bars_frame, day_seq
from tickwise.operators import labels as L
from tickwise.operators import split as S


def test_quantile_interpolation(spark):
    """The yearly threshold interpolates: returns 1, 0.5 and 2 have 0.6-quantile 1.2."""
    rows = [("A", d, c) for d, c in zip(day_seq(4, "2019-01-01"), (1.0, 2.0, 3.0, 9.0))]
    out = L.yearly_quantile_label(bars_frame(spark, rows), horizon=1, keep_threshold=True).toPandas()
    out = out.sort_values("date")
    np.testing.assert_allclose(out["target_3m_raw"][:3], [1.0, 0.5, 2.0])
    np.testing.assert_allclose(out["threshold"], 1.2)
    assert out["target_3m"].tolist() == [0, 0, 1, 0]


def test_tail_labels_zero_and_null(spark):
    n = 200
    rng = np.random.default_rng(3)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    df = bars_frame(spark, [("A", d, float(x)) for d, x in zip(day_seq(n, "2019-01-01"), c)])
    z = L.yearly_quantile_label(df, tail="zero").toPandas().sort_values("date")
    nl = L.yearly_quantile_label(df, tail="null").toPandas().sort_values("date")
    assert z["target_3m_raw"].iloc[-63:].isna().all()
    assert (z["target_3m"].iloc[-63:] == 0).all()
    assert nl["target_3m"].iloc[-63:].isna().all()
    # pandas reference of the labelled part
    s = pd.Series(c)
    raw = s.shift(-63) / s - 1
    thr = raw.quantile(0.6)
    exp = (raw > thr).astype(int)
    assert (z["target_3m"].to_numpy() == exp.to_numpy()).all()


def test_year_edge_threshold_changes(spark):
    days = day_seq(400, "2019-06-01")
    rng = np.random.default_rng(4)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, len(days))))
    df = bars_frame(spark, [("A", d, float(x)) for d, x in zip(days, c)])
    out = L.yearly_quantile_label(df, keep_threshold=True).toPandas()
    out["year"] = pd.to_datetime(out["date"]).dt.year
    per_year = out.groupby("year")["threshold"].nunique()
    assert (per_year == 1).all() and out.groupby("year")["threshold"].first().nunique() == 2


def test_label_distribution(spark):
    df = bars_frame(spark, [("A", d, float(100 + i % 7)) for i, d in enumerate(day_seq(150))])
    lab = L.yearly_quantile_label(df)
    row = L.label_distribution(lab).first()
    assert row["n_samples"] == 150 and row["n_pos"] + row["n_neg"] == 150
    assert abs(row["share_pos"] + row["share_neg"] - 1) < 1e-12


def test_split_holiday_parity_vs_strict(spark):
    # no bar on the split date 2020-01-04
    days = [d for d in day_seq(8, "2020-01-01") if d != "2020-01-04"]
    df = bars_frame(spark, [("A", d, 1.0 + i) for i, d in enumerate(days)])
    par = {r["date"].isoformat(): r["split"] for r in
           S.temporal_split(df, "2020-01-04").collect()}
    strict = {r["date"].isoformat(): r["split"] for r in
              S.temporal_split(df, "2020-01-04", parity=False).collect()}
    assert par["2020-01-03"] is None and strict["2020-01-03"] == "train"
    assert par["2020-01-05"] == "test" and par["2020-01-01"] == "train"
    # with a bar on the split date it is test only
    df2 = bars_frame(spark, [("A", d, 1.0) for d in day_seq(6, "2020-01-01")])
    p2 = {r["date"].isoformat(): r["split"] for r in
          S.temporal_split(df2, "2020-01-04").collect()}
    assert p2["2020-01-04"] == "test" and p2["2020-01-03"] == "train"


def test_walk_forward_folds_n20(spark):
    df = bars_frame(spark, [("A", d, 1.0) for d in day_seq(20)])
    out = S.walk_forward_folds(df).toPandas().sort_values("row_idx")
    starts = [int(out[out.test_fold == k].row_idx.min()) for k in range(5)]
    assert starts == [5, 8, 11, 14, 17]
    assert (out[out.row_idx < 5].test_fold == -1).all()
    assert out.groupby("test_fold").size().drop(-1).tolist() == [3, 3, 3, 3, 3]


def test_recency_weights_and_class_balance(spark):
    days = day_seq(61)
    df = spark.createDataFrame(
        [("A", dt.date.fromisoformat(d), i % 3 == 0 and 1 or 0) for i, d in enumerate(days)],
        "symbol string, date date, target_3m int")
    w = S.recency_weights(df).toPandas().sort_values("date")
    assert abs(w["weight"].iloc[-1] - 1.0) < 1e-15
    assert abs(w["weight"].iloc[0] - 0.99 ** 2) < 1e-12
    cb = S.class_balance(df).first()
    assert cb["positives"] == 21 and cb["negatives"] == 40
    assert abs(cb["pos_scale"] - 40 / 21) < 1e-12
    none = spark.createDataFrame([("B", dt.date(2020, 1, 1), 0)] * 3,
                                 "symbol string, date date, target_3m int")
    nb = S.class_balance(none).first()
    assert nb["positives"] == 0 and nb["pos_scale"] == 3.0
    sw = S.scale_positive_weights(S.recency_weights(df)).toPandas()
    pos = sw[sw.target_3m == 1]
    assert (pos["weight"] > 1).any()


def test_distributed_index_and_pooled_folds(spark):
    from tickwise.functions.frames import distributed_index
    days = day_seq(240)
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "date date")
    idx = distributed_index(df.repartition(5), "date").toPandas().sort_values("date")
    assert idx["idx"].tolist() == list(range(240))
    two = bars_frame(spark, [(s, d, 1.0) for s in ("A", "B") for d in days[:20]])
    folds = S.pooled_walk_forward_folds(two).toPandas()
    first = folds.groupby("test_fold")["date"].min().drop(-1).sort_index()
    assert [d.isoformat() for d in first] == [days[i] for i in (5, 8, 11, 14, 17)]
    assert folds.groupby("date")["test_fold"].nunique().max() == 1
