"""Boosted-tree growth classifier on Spark ML.

One pooled model is trained over all symbols (the reference fits one model
per ticker in a loop; ``fit_per_symbol`` keeps that mode for few symbols).
Spark ML's GBT rejects missing values, so a median ``Imputer`` fitted on
training rows only fills them, and a 0/1 flag per input column keeps the
"was missing" signal that XGBoost would use natively.

The training frame is written to the session's shared checkpoint folder
before fitting: every boosting round and every search fit then reads those
rows instead of re-running the feature windows, and a lost executor re-reads
files rather than the whole lineage.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .evaluate import best_threshold, f1_score, predict
from .split import pooled_walk_forward_folds, recency_weights, scale_positive_weights

# The reference's search space mapped to Spark ML GBT
# parameters (n_estimators -> maxIter, learning_rate -> stepSize,
# max_depth -> maxDepth, min_child_weight -> minInstancesPerNode,
# subsample -> subsamplingRate, colsample_bytree -> featureSubsetStrategy,
# gamma -> minInfoGain; reg_alpha / reg_lambda have no counterpart).
# gamma (0, 0.5, 1.0) bounds the loss reduction summed over a node's rows,
# minInfoGain the reduction of variance per row, so it is divided by ROWS_PER_GAIN.
ROWS_PER_GAIN = 10_000
SEARCH_SPACE = {
    "maxIter": [300, 500, 700, 900],
    "stepSize": [0.01, 0.03, 0.05, 0.1],
    "maxDepth": [3, 4, 5, 6, 8],
    "minInstancesPerNode": [1, 3, 5, 7],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.6", "0.8", "1.0"],
    "minInfoGain": [0.0, 0.5 / ROWS_PER_GAIN, 1.0 / ROWS_PER_GAIN],
}
# The reference's fall-back parameters of the pooled pass.
DEFAULT_PARAMS = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 3,
                  "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
                  "minInfoGain": 0.5 / ROWS_PER_GAIN}


def add_missing_flags(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """0/1 ``<c>_missing`` column per feature; inputs cast to double."""
    flags = [f"{c}_missing" for c in features]
    out = df.select(*[c for c in df.columns if c not in features],
                    *[F.col(c).cast("double").alias(c) for c in features],
                    *[F.col(c).isNull().cast("double").alias(m) for c, m in zip(features, flags)])
    return out, flags


def gbt_pipeline(features: list[str], flags: list[str], params: dict, label: str = "label",
                 weight: str | None = "weight", seed: int = 42) -> Pipeline:
    """Imputer (median, train-fitted) -> VectorAssembler -> GBTClassifier."""
    imputed = [f"{c}_imp" for c in features]
    imp = Imputer(strategy="median", inputCols=features, outputCols=imputed)
    asm = VectorAssembler(inputCols=imputed + flags, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", lossType="logistic",
                        seed=seed, **params)
    if weight:
        gbt.setWeightCol(weight)
    return Pipeline(stages=[imp, asm, gbt])


def usable_features(train: DataFrame, features: list[str]) -> list[str]:
    """Drop inputs that are NULL on every training row (the imputer has no
    median for them); one aggregate row of counts comes back to the driver."""
    counts = train.agg(*[F.count(F.col(c)).alias(c) for c in features]).first()
    return [c for c in features if counts[c] > 0]


def training_frame(panel: DataFrame, features: list[str], split_col: str = "split",
                   label: str = "target_3m", weighted: bool = True,
                   class_scale: bool = True, embargo_rows: int = 0) -> DataFrame:
    """Training rows with ``label`` (double) and ``weight``: recency weight
    (F6) times the positive-class scale (M5), both per symbol.  The last
    ``embargo_rows`` labelled training rows of a symbol, whose labels look into
    the test period, are left out."""
    tr = panel.where((F.col(split_col) == "train") & F.col(label).isNotNull())
    if embargo_rows:
        back = Window.partitionBy("symbol").orderBy(F.col("date").desc())
        tr = tr.withColumn("_back", F.row_number().over(back)).where(F.col("_back") > embargo_rows).drop("_back")
    if weighted:
        tr = recency_weights(tr)
    if class_scale:
        tr = scale_positive_weights(tr, label=label)
    keep = ["symbol", "date", label] + features + (["weight"] if "weight" in tr.columns else [])
    return tr.select(*keep).withColumn("label", F.col(label).cast("double"))


def fit_gbt(train: DataFrame, features: list[str], params: dict | None = None,
            weight: str | None = "weight", checkpoint: bool = True) -> PipelineModel:
    """M3: fit the pipeline on ``train`` (needs ``label`` and, if given,
    ``weight``)."""
    params = dict(DEFAULT_PARAMS if params is None else params)
    data, flags = add_missing_flags(train, features)
    if checkpoint:
        data = materialize(data)
    w = weight if (weight and weight in data.columns) else None
    return gbt_pipeline(features, flags, params, weight=w).fit(data)


def score(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """M7: ``p`` = probability of class 1."""
    data, _ = add_missing_flags(df, features)
    out = model.transform(data)
    return out.withColumn("p", vector_to_array("probability").getItem(1))


def sample_params(space: dict = SEARCH_SPACE, n_iter: int = 40, seed: int = 42) -> list[dict]:
    """Seeded draw of ``n_iter`` distinct points of the grid (M4)."""
    keys = sorted(space)
    grid = list(itertools.product(*[space[k] for k in keys]))
    rng = random.Random(seed)
    picks = rng.sample(range(len(grid)), min(n_iter, len(grid)))
    return [dict(zip(keys, grid[i])) for i in picks]


def _fold_rows(data: DataFrame, fold: int, embargo_rows: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a walk-forward fold: training ends ``embargo_rows`` dates
    before the first date that is tested, whose labels it would look into."""
    first = data.where(F.col("test_fold") == fold).agg(F.min("date_idx")).first()[0] or 0
    return (data.where((F.col("test_fold") < fold) & (F.col("date_idx") < first - embargo_rows)),
            data.where(F.col("test_fold") == fold))


def _held_back(fold_train: DataFrame, share: float, embargo_rows: int) -> DataFrame:
    """Marks the last ``share`` of a fold's training dates in ``_check``, for early
    stopping; the ``embargo_rows`` dates before them are left out."""
    top = fold_train.agg(F.max("date_idx"), F.min("date_idx")).first()
    if top[0] is None:
        return fold_train.withColumn("_check", F.lit(False))
    first = math.ceil(top[0] - share * (top[0] - top[1]))
    return (fold_train.where((F.col("date_idx") >= first) | (F.col("date_idx") < first - embargo_rows))
            .withColumn("_check", F.col("date_idx") >= first))


class SearchResults:
    """The finished fits of a search as a table (draw, fold, params, f1, rounds).

    Every fit is written as a folder of its own when it ends, below a name that
    depends on all that the fits depend on; a later run of the same search reads
    what is there and fits the rest.  A fit that was cut off leaves no rows.
    """

    def __init__(self, spark: SparkSession, path: str, setting: dict):
        name = hashlib.sha256(json.dumps(setting, sort_keys=True).encode()).hexdigest()[:16]
        self.spark, self.path = spark, f"{path.rstrip('/')}/{name}"

    def read(self) -> dict[tuple[int, int], float]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return {}
        rows = self.spark.read.schema("f1 double, rounds int, params string, draw int, fold int").parquet(self.path)
        return {(r.draw, r.fold): r.f1 for r in rows.collect()}

    def write(self, draw: int, fold: int, params: dict, f1: float, rounds: int) -> None:
        row = self.spark.createDataFrame([(f1, rounds, json.dumps(params, sort_keys=True))],
                                         "f1 double, rounds int, params string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/draw={draw}/fold={fold}")


def random_search(train: DataFrame, features: list[str], space: dict = SEARCH_SPACE,
                  n_iter: int = 40, n_splits: int = 5, seed: int = 42, parallelism: int = 4,
                  weight: str | None = "weight", embargo_rows: int = 0, results: str | None = None,
                  validation_share: float = 0.0,
                  validation_tol: float = 0.001) -> tuple[dict, float, PipelineModel]:
    """M4: mean F1 (cut-off 0.5) over walk-forward folds for ``n_iter`` sampled
    parameter sets, then a refit of the best on all training rows.

    Folds are cut on the calendar of training dates (pooled model);
    ``embargo_rows`` dates before a test fold train nothing, since their labels
    look into it.  Imputer and assembler are fitted once a fold.  Fits are
    independent Spark jobs, submitted from a small thread pool.

    ``results``: a folder that all executors share, where each finished fit is
    kept (:class:`SearchResults`); a search that was lost goes on from there.
    ``validation_share``: that share of a fold's training dates, its last ones,
    trains nothing but tells when more rounds improve the loss by less than
    ``validation_tol``, so the rounds of a draw are an upper bound.
    """
    spark = train.sparkSession
    data, flags = add_missing_flags(train, features)
    data = materialize(pooled_walk_forward_folds(data, n_splits))
    w = weight if (weight and weight in data.columns) else None
    cands = sample_params(space, n_iter, seed)
    kept = None
    if results:
        count = data.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*data.columns).cast("decimal(38,0)"))).first()
        kept = SearchResults(spark, results, {
            "space": space, "n_iter": n_iter, "n_splits": n_splits, "seed": seed, "features": features, "weight": w,
            "embargo": embargo_rows, "validation": [validation_share, validation_tol], "rows": [str(x) for x in count]})
    done = kept.read() if kept else {}

    folds = {}
    for k in sorted({k for i in range(len(cands)) for k in range(n_splits) if (i, k) not in done}):
        fold_train, fold_test = _fold_rows(data, k, embargo_rows)
        # early folds may not have seen some inputs yet (e.g. a macro series
        # that starts later): a fold's model uses the inputs observed in its
        # own training rows only
        fk = usable_features(fold_train, features)
        prepare = gbt_pipeline(fk, [f"{c}_missing" for c in fk], {}, weight=w, seed=seed).getStages()[:-1]
        ready = Pipeline(stages=prepare).fit(fold_train)
        if validation_share:
            fold_train = _held_back(fold_train, validation_share, embargo_rows)
        own = ["features", "label", *([w] if w else [])]
        folds[k] = (materialize(ready.transform(fold_train).select(*own, *(["_check"] if validation_share else []))),
                    materialize(ready.transform(fold_test).select(*own)))

    def run(task: tuple[int, int]) -> float:
        i, k = task
        fold_train, fold_test = folds[k]
        gbt = gbt_pipeline([], [], cands[i], weight=w, seed=seed).getStages()[-1]
        if validation_share:
            gbt = gbt.setValidationIndicatorCol("_check").setParams(validationTol=validation_tol)
        m = gbt.fit(fold_train)
        pr = m.transform(fold_test).withColumn("pred", F.col("prediction").cast("int"))
        row = f1_score(pr.withColumn("symbol", F.lit("*"))).first()
        f1 = row["f1"] if row else 0.0
        if kept:
            kept.write(i, k, cands[i], f1, m.getNumTrees)
        return f1

    todo = [(i, k) for i in range(len(cands)) for k in range(n_splits) if (i, k) not in done]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        done |= dict(zip(todo, ex.map(run, todo)))
    means = [sum(done[i, k] for k in range(n_splits)) / n_splits for i in range(len(cands))]
    best_i = max(range(len(cands)), key=lambda i: (means[i], -i))
    best = cands[best_i]
    model = gbt_pipeline(features, flags, best, weight=w, seed=seed).fit(data)
    return best, means[best_i], model


def out_of_fold_scores(train: DataFrame, features: list[str], params: dict | None = None, n_splits: int = 5,
                       embargo_rows: int = 0, weight: str | None = "weight", seed: int = 42) -> DataFrame:
    """``(symbol, date, label, p, test_fold)``: each training row of a walk-forward
    fold, scored by a model that was fitted on earlier dates only (M2 folds of
    the pooled calendar, ``embargo_rows`` dates apart).  The rows ahead of the
    first fold are scored by none and have no row here."""
    data, _ = add_missing_flags(train, features)
    data = materialize(pooled_walk_forward_folds(data, n_splits))
    w = weight if (weight and weight in data.columns) else None
    out = None
    for k in range(n_splits):
        fold_train, fold_test = _fold_rows(data, k, embargo_rows)
        fk = usable_features(fold_train, features)
        if not fk:  # too little history ahead of this fold
            continue
        model = gbt_pipeline(fk, [f"{c}_missing" for c in fk], dict(DEFAULT_PARAMS if params is None else params),
                             weight=w, seed=seed).fit(fold_train)
        own = model.transform(fold_test).withColumn("p", vector_to_array("probability").getItem(1)).select(
            "symbol", "date", "label", "p", "test_fold")
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no fold has training rows")
    return materialize(out)


def out_of_fold_cutoffs(train: DataFrame, features: list[str], params: dict | None = None, n_splits: int = 5,
                        embargo_rows: int = 0, weight: str | None = "weight") -> DataFrame:
    """M6 on unseen rows: the best F1 threshold per symbol over out-of-fold scores."""
    scores = out_of_fold_scores(train, features, params, n_splits, embargo_rows, weight)
    return best_threshold(scores.select("symbol", "label", "p"))


def tuned_cutoffs(model: PipelineModel, train: DataFrame, features: list[str]) -> DataFrame:
    """M6 on in-sample training scores: best F1 threshold per symbol."""
    s = score(model, train, features).select("symbol", "label", "p")
    return best_threshold(s)


def scores_with_cutoff(model: PipelineModel, test: DataFrame, features: list[str],
                       cutoffs: DataFrame | float) -> DataFrame:
    """M7 + F11: ``(symbol, date, label, p, pred)`` for scored rows."""
    s = score(model, test, features).select("symbol", "date", "label", "p")
    if isinstance(cutoffs, (int, float)):
        return predict(s, float(cutoffs))
    return predict(s.join(cutoffs.select("symbol", "threshold"), "symbol", "left")
                   .fillna({"threshold": 0.5}), "threshold").drop("threshold")


def fit_per_symbol(train: DataFrame, features: list[str], params: dict | None = None,
                   weight: str | None = "weight", parallelism: int = 4) -> dict[str, PipelineModel]:
    """M8 (reference mode): one model per symbol, for a handful of symbols.
    The symbol list is collected (one row per symbol); the rows are written once
    and fits run side by side, each a Spark job on its symbol's rows and on the
    inputs seen there.  The pooled :func:`fit_gbt` is the default."""
    train = materialize(train)
    symbols = sorted(r[0] for r in train.where("symbol is not null").select("symbol").distinct().collect())

    def fit(symbol: str) -> PipelineModel:
        own = train.where(F.col("symbol") == symbol)
        return fit_gbt(own, usable_features(own, features), params, weight, checkpoint=False)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return dict(zip(symbols, ex.map(fit, symbols)))


def score_per_symbol(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """M8 + M7: ``df`` with ``p`` by the model of each row's symbol, on the inputs that
    model was fitted on (doubles, as in :func:`score`).  Rows whose symbol has no
    model keep a NULL ``p``."""
    known = F.coalesce(F.col("symbol").isin(sorted(models)), F.lit(False))
    out = df.where(~known).withColumn("p", F.lit(None).cast("double"))
    for symbol in sorted(models):
        # the imputer's inputs are the model's
        inputs = models[symbol].stages[0].getInputCols()
        scored = score(models[symbol], df.where(F.col("symbol") == symbol), inputs)
        out = out.unionByName(scored.select(*df.columns, "p"))
    return out


def pooled_report(panel: DataFrame, features: list[str], params: dict | None = None,
                  split_col: str = "split", label: str = "target_3m",
                  include_raw_target: bool = False, embargo_rows: int = 0):
    """M9 + A4 + A5/A6: the reference's second pass -- fixed parameters, no
    recency weights (positive-class scale kept), cut-off 0.5 -- returning
    ``(confusion cells incl. the sum over symbols, mean feature/label
    correlation on training rows)``."""
    from .evaluate import confusion, label_correlation, mean_correlation
    train = training_frame(panel, features, split_col, label, weighted=False, class_scale=True,
                           embargo_rows=embargo_rows)
    model = fit_gbt(train, features, params)
    test = (panel.where((F.col(split_col) == "test") & F.col(label).isNotNull())
            .withColumn("label", F.col(label).cast("double")))
    pred = scores_with_cutoff(model, test, features, 0.5)
    corr_cols = features + (["target_3m_raw"] if include_raw_target else [])
    corr_src = panel.where(F.col(split_col) == "train")
    return confusion(pred), mean_correlation(label_correlation(corr_src, corr_cols, label=label))


def save_model(model: PipelineModel, path: str) -> str:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_features(df: DataFrame, path: str, partition_by: str = "symbol") -> str:
    """Feature / metric sink, partitioned by symbol."""
    df.repartition(partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return path


def upsert_features(df: DataFrame, table: str, path: str, day: str = "day", order: str = "date", key: str = "symbol",
                    buckets: int = 16) -> str:
    """S7, incremental: ``df`` into an external table at ``path`` (a shared folder),
    partitioned by the column ``day``, bucketed by ``key`` and sorted.

    The first call makes the table.  Later ones replace just the partitions whose
    days occur in ``df``; others keep their files.  All partitions share the
    buckets, so windows and joins on ``key`` read the table without an exchange.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        (df.repartition(buckets, key).write.format("parquet").option("path", path).partitionBy(day)
         .bucketBy(buckets, key).sortBy(key, order).saveAsTable(table))
        return table
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        columns = spark.table(table).columns  # partitions come last, as insertInto expects
        df.select(*columns).repartition(buckets, key).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return table
