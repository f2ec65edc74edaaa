"""Model operators: fit, score, cut-offs, search, persistence, sinks."""

import datetime as dt
import tempfile

import numpy as np

from tickwise.operators import train as T


def _panel(spark, n=240):
    rng = np.random.default_rng(0)
    rows = []
    for s in ("A", "B"):
        for i in range(n):
            x1 = float(rng.normal())
            x2 = None if i % 17 == 0 else float(rng.normal())
            y = int(x1 + 0.3 * rng.normal() > 0)
            split = "train" if i < 180 else "test"
            rows.append((s, dt.date(2020, 1, 1) + dt.timedelta(days=i), x1, x2, y, split))
    return spark.createDataFrame(rows, "symbol string, date date, x1 double, x2 double, "
                                       "target_3m int, split string")


def test_fit_score_cutoffs_and_persist(spark):
    panel = _panel(spark)
    feats = ["x1", "x2"]
    train = T.training_frame(panel, feats)
    assert "weight" in train.columns
    model = T.fit_gbt(train, feats, {"maxIter": 5, "maxDepth": 3})
    cut = T.tuned_cutoffs(model, train, feats)
    assert cut.count() == 2
    test = panel.where("split = 'test'").withColumnRenamed("target_3m", "label")
    out = T.scores_with_cutoff(model, test, feats, cut).toPandas()
    assert len(out) == 120 and out["p"].between(0, 1).all()
    assert ((out["p"] > 0.5) == (out["label"] == 1)).mean() > 0.7
    path = tempfile.mkdtemp(prefix="tickwise-model-") + "/m"
    T.save_model(model, path)
    again = T.load_model(path)
    out2 = T.scores_with_cutoff(again, test, feats, 0.5).toPandas()
    np.testing.assert_allclose(sorted(out2["p"]), sorted(out["p"]))


def test_random_search_small(spark):
    panel = _panel(spark, n=120)
    feats = ["x1", "x2"]
    train = T.training_frame(panel, feats)
    space = {"maxIter": [2, 3], "maxDepth": [2, 3]}
    best, score, model = T.random_search(train, feats, space, n_iter=2, n_splits=2,
                                         parallelism=2)
    assert set(best) == {"maxIter", "maxDepth"} and 0.0 <= score <= 1.0
    assert model.transform(T.add_missing_flags(train, feats)[0]).count() == train.count()
    assert len(T.sample_params(n_iter=40)) == 40


def test_write_features(spark):
    panel = _panel(spark, n=10)
    path = tempfile.mkdtemp(prefix="tickwise-sink-") + "/panel"
    T.write_features(panel, path)
    back = spark.read.parquet(path)
    assert back.count() == panel.count() and "symbol" in back.columns


def test_per_symbol_and_pooled_report(spark):
    panel = _panel(spark, n=120)
    feats = ["x1", "x2"]
    models = T.fit_per_symbol(T.training_frame(panel, feats), feats, {"maxIter": 2, "maxDepth": 2})
    assert sorted(models) == ["A", "B"]
    cells, corr = T.pooled_report(_panel(spark), feats, {"maxIter": 2, "maxDepth": 2})
    c = cells.toPandas()
    assert len(c) == 12 and int(c[c.symbol == "ALL"].n.sum()) == 2 * 60
    m = {r["feature"]: r["mean_corr"] for r in corr.collect()}
    assert m["x1"] > 0.5


def test_default_parameters_split(spark):
    """The default model grows real trees and tells rows apart."""
    panel = _panel(spark)
    train = T.training_frame(panel, ["x1", "x2"])
    model = T.fit_gbt(train, ["x1", "x2"], T.DEFAULT_PARAMS | {"maxIter": 5})
    assert all(tree.numNodes > 3 for tree in model.stages[-1].trees)
    assert T.score(model, train, ["x1", "x2"]).select("p").distinct().count() > 50


def test_embargo_drops_the_last_training_rows(spark):
    panel = _panel(spark)
    whole, cut = (T.training_frame(panel, ["x1"], embargo_rows=n).groupBy("symbol").agg({"date": "max", "*": "count"}).collect()
                  for n in (0, 63))
    assert all(a["count(1)"] - b["count(1)"] == 63 and a["max(date)"] > b["max(date)"] for a, b in zip(sorted(whole), sorted(cut)))


def test_search_goes_on_where_it_was_lost(spark, monkeypatch):
    """A restart repeats no finished fit, and ends as an undisturbed search does."""
    train = T.training_frame(_panel(spark, n=120), ["x1", "x2"])
    space, path = {"maxIter": [2, 3], "maxDepth": [2, 3]}, tempfile.mkdtemp(prefix="tickwise-search-")
    search = lambda **kw: T.random_search(train, ["x1", "x2"], space, n_iter=2, n_splits=2, parallelism=1, **kw)[:2]
    whole = search()
    fitted, write = [], T.SearchResults.write

    def lost(self, draw, fold, *rest):
        if len(fitted) == 3:
            raise RuntimeError("lost")
        fitted.append((draw, fold))
        write(self, draw, fold, *rest)

    monkeypatch.setattr(T.SearchResults, "write", lost)
    try:
        search(results=path)
        raise AssertionError("the search should have been lost")
    except RuntimeError:
        pass
    again = []
    monkeypatch.setattr(T.SearchResults, "write", lambda self, draw, fold, *rest: (again.append((draw, fold)),
                                                                                  write(self, draw, fold, *rest)))
    assert search(results=path) == whole
    assert len(fitted) == 3 and len(again) == 1 and not set(again) & set(fitted)
    again.clear()
    assert search(results=path) == whole and not again
    assert search(results=path, embargo_rows=5) != () and len(again) == 4  # another search shares nothing


def test_search_stops_early(spark):
    train = T.training_frame(_panel(spark, n=200), ["x1", "x2"])
    path = tempfile.mkdtemp(prefix="tickwise-search-")
    T.random_search(train, ["x1", "x2"], {"maxIter": [40], "maxDepth": [4]}, n_iter=1, n_splits=2, results=path,
                    validation_share=0.3, validation_tol=0.01)
    rows = spark.read.option("basePath", path).parquet(path + "/*").collect()
    assert len(rows) == 2 and all(r.rounds < 40 for r in rows)


def test_out_of_fold_scores_see_no_later_date(spark):
    """Labels that say nothing are not told from other dates, and changing a later
    row changes no earlier score."""
    rng = np.random.default_rng(3)
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(rng.normal()), int(rng.random() < 0.5), "train")
            for s in "AB" for i in range(200)]
    schema = "symbol string, date date, x1 double, target_3m int, split string"
    train = T.training_frame(spark.createDataFrame(rows, schema), ["x1"])
    params = {"maxIter": 4, "maxDepth": 4, "minInstancesPerNode": 1}
    scores = T.out_of_fold_scores(train, ["x1"], params, n_splits=4, embargo_rows=3).toPandas()
    assert len(scores) == 2 * 160 and sorted(scores.test_fold.unique()) == [0, 1, 2, 3]
    hit = ((scores.p > 0.5) == (scores.label == 1)).mean()
    assert hit < 0.62
    changed = [r if r[1] < dt.date(2020, 6, 1) else (*r[:2], r[2] + 5, 1 - r[3], r[4]) for r in rows]
    other = T.training_frame(spark.createDataFrame(changed, schema), ["x1"], weighted=False, class_scale=False)
    plain = T.training_frame(spark.createDataFrame(rows, schema), ["x1"], weighted=False, class_scale=False)
    a, b = (T.out_of_fold_scores(x, ["x1"], params, n_splits=4).toPandas().sort_values(["symbol", "date"]) for x in (plain, other))
    early = (a.date < dt.date(2020, 6, 1)).to_numpy()
    np.testing.assert_allclose(a.p.to_numpy()[early], b.p.to_numpy()[early])
    cut = T.out_of_fold_cutoffs(train, ["x1"], params, n_splits=2).collect()
    assert {r.symbol for r in cut} == {"A", "B"} and all(0.05 <= r.threshold <= 0.95 for r in cut)


def test_upsert_touches_one_day(spark):
    """Only the partition of the day is written again, and windows by symbol read
    the table without an exchange."""
    import os
    from pyspark.sql import functions as F
    from tickwise.functions.columns import panel_window
    panel = _panel(spark, n=12).withColumn("day", F.col("date"))
    path, name = tempfile.mkdtemp(prefix="tickwise-table-") + "/t", "upserted_features"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    T.upsert_features(panel, name, path, buckets=4)
    files = lambda: {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
                     for d in os.listdir(path) if d.startswith("day=")}
    before = files()
    T.upsert_features(panel.where("day = '2020-01-05'").withColumn("x1", F.lit(9.0)), name, path, buckets=4)
    after = files()
    assert len(before) == 12 and [d for d in before if before[d] != after[d]] == ["day=2020-01-05"]
    table = spark.table(name)
    assert table.count() == panel.count() and table.where("x1 = 9").count() == 2
    plan = table.withColumn("last", F.lag("x1").over(panel_window()))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    spark.sql(f"DROP TABLE {name}")


def test_score_per_symbol(spark):
    """Each row by its symbol's model; rows without one keep a NULL score."""
    panel = _panel(spark, n=120)
    feats = ["x1", "x2"]
    models = T.fit_per_symbol(T.training_frame(panel, feats), feats, {"maxIter": 2, "maxDepth": 2})
    other = spark.createDataFrame([("C", 1.0, None), (None, 1.0, 2.0)], "symbol string, x1 double, x2 double")
    out = T.score_per_symbol(models, panel.select("symbol", "x1", "x2").unionByName(other)).toPandas()
    assert list(out.columns) == ["symbol", "x1", "x2", "p"] and len(out) == 242
    assert out.p.notna().sum() == 240 and out[out.symbol.isin(["A", "B"])].p.between(0, 1).all()
    for s in ("A", "B"):
        alone = T.score(models[s], panel.where(f"symbol = '{s}'"), feats).toPandas()
        np.testing.assert_allclose(sorted(out[out.symbol == s].p), sorted(alone.p))
    assert T.score_per_symbol({}, panel).where("p is not null").count() == 0
