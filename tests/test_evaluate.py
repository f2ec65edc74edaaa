"""Evaluation operators against sklearn-style definitions."""

import datetime as dt

import numpy as np

from tickwise.operators import evaluate as E


def _scored(spark, p, y, sym="A"):
    return spark.createDataFrame(
        [(sym, dt.date(2020, 1, 1) + dt.timedelta(days=i), int(b), float(a))
         for i, (a, b) in enumerate(zip(p, y))],
        "symbol string, date date, label int, p double")


def test_auc_with_ties(spark):
    sc = _scored(spark, [.1, .4, .35, .8, .4], [0, 1, 0, 1, 0])
    r = E.roc_auc(sc).first()
    assert abs(r["auc"] - 0.916666666667) < 1e-9
    assert r["n_pos"] == 2 and r["n_neg"] == 3


def test_threshold_sweep_matches_direct_and_ties(spark):
    rng = np.random.default_rng(0)
    p = np.round(rng.random(500), 2)   # many ties, some on grid values
    y = (rng.random(500) < p).astype(int)
    sw = E.threshold_sweep(_scored(spark, p, y)).toPandas().sort_values("t_idx")
    ts = np.linspace(0.05, 0.95, 50)
    f1s = []
    for t in ts:
        pr = (p >= t).astype(int)
        tp, fp, fn = ((pr == 1) & (y == 1)).sum(), ((pr == 1) & (y == 0)).sum(), ((pr == 0) & (y == 1)).sum()
        f1s.append(0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn))
    np.testing.assert_array_equal(sw["threshold"].to_numpy(), ts)
    np.testing.assert_allclose(sw["f1"].to_numpy(), f1s, rtol=1e-12)
    assert int(sw[sw.is_best].t_idx.iloc[0]) == int(np.argmax(f1s))
    # all-equal F1 -> the lowest threshold wins
    flat = E.threshold_sweep(_scored(spark, [0.99, 0.99], [1, 1])).toPandas()
    assert int(flat[flat.is_best].t_idx.iloc[0]) == 0


def test_no_positives(spark):
    sc = _scored(spark, [0.2, 0.7, 0.9], [0, 0, 0])
    pr = E.predict(sc, 0.5)
    assert E.f1_score(pr).first()["f1"] == 0.0
    assert E.roc_auc(sc).first()["auc"] is None
    rep = {r["class_label"]: r for r in E.classification_report(pr).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["support"] == 0
    assert abs(rep["accuracy"]["f1"] - 1 / 3) < 1e-12


def test_confusion_and_report(spark):
    sc = E.predict(_scored(spark, [.9, .2, .7, .1, .6], [1, 0, 0, 1, 1]), 0.5)
    cells = {(r["symbol"], r["label"], r["pred"]): r["n"] for r in E.confusion(sc).collect()}
    assert cells[("A", 1, 1)] == 2 and cells[("A", 0, 1)] == 1
    assert cells[("A", 1, 0)] == 1 and cells[("A", 0, 0)] == 1
    assert cells[("ALL", 1, 1)] == 2 and len(cells) == 8
    rep = {r["class_label"]: r for r in E.classification_report(sc).collect()}
    assert abs(rep["1"]["precision"] - 2 / 3) < 1e-12 and abs(rep["1"]["recall"] - 2 / 3) < 1e-12
    assert abs(rep["macro avg"]["f1"] - (rep["0"]["f1"] + rep["1"]["f1"]) / 2) < 1e-12
    acc = E.accuracy(sc).first()
    assert abs(acc["accuracy"] - 3 / 5) < 1e-12


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([("A", float(i), 1.0, i % 2) for i in range(10)],
                               "symbol string, x double, flat double, target_3m int")
    c = {r["feature"]: r["corr"] for r in E.label_correlation(df, ["x", "flat"]).collect()}
    assert c["flat"] is None
    x = np.arange(10.0)
    y = np.arange(10) % 2
    assert abs(c["x"] - np.corrcoef(x, y)[0, 1]) < 1e-12
    m = E.mean_correlation(E.label_correlation(df, ["x", "flat"])).collect()
    assert m[0]["feature"] == "x"


def test_auc_distributed_prefix_matches_rank_formula(spark):
    rng = np.random.default_rng(9)
    n = 3000
    p = np.round(rng.random(n), 3)           # many ties
    y = (rng.random(n) < p).astype(int)
    sc = _scored(spark, p, y).repartition(7)
    got = E.roc_auc(sc).first()["auc"]
    import pandas as pd
    r = pd.Series(p).rank(method="average").to_numpy()
    P, N = y.sum(), n - y.sum()
    exp = (r[y == 1].sum() - P * (P + 1) / 2) / (P * N)
    assert abs(got - exp) < 1e-12
