"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the coverage checklist.  Every query reads the landed tables
(or data Spark derives from them) in full; nothing is sampled or capped.

Outputs keep their key columns and round doubles (6 decimals, 9
significant digits above 100, IEEE-only arithmetic) so the DuckDB oracle of
:mod:`tickwise.plans.oracle_sql` can be compared by value hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ffill, panel_window, round_cols
from ..session import ensure_checkpoint_dir, materialize, shared
from . import panel as PN
from ..operators import evaluate as E
from ..operators import fundamentals as FU
from ..operators import indicators as I
from ..operators import labels as L
from ..operators import macro as M
from ..operators import price as P
from ..operators import relative as RS
from ..operators import split as S
from ..operators import train as T
from ..operators.smoothing import ewm_mean
from ..sources import bars as B
from ..sources import macro as SM
from ..sources import statements as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


KEYS = ["symbol", "date"]


def _price(spark, sf_dir, cols):
    feats = P.price_features(B.bars_daily(spark, sf_dir))
    return round_cols(feats.select(*KEYS, *cols))


# ------------------------------------------------------------------ step 1
@query("bars_daily")
def bars_daily(spark, sf_dir):
    return round_cols(B.bars_daily(spark, sf_dir))


@query("bars_hourly")
def bars_hourly(spark, sf_dir):
    return round_cols(B.bars_hourly(spark, sf_dir))


@query("hourly_price_features")
def hourly_price_features(spark, sf_dir):
    """The same price windows on hourly event bars (zero prices occur:
    divisions by zero give NULL)."""
    feats = P.price_features(B.bars_hourly(spark, sf_dir))
    return round_cols(feats.select(*KEYS, *P.PRICE_FEATURES))


@query("bars_filtered")
def bars_filtered(spark, sf_dir):
    """Bars of two symbols and three years, read with pushed filters."""
    return round_cols(B.bars_daily(spark, sf_dir, symbols=["ASIA", "EUROPE"],
                                   start="1994-03-01", end="1997-02-28"))


@query("gapped_indicators")
def gapped_indicators(spark, sf_dir):
    """Indicators over bars without a price on every seventh
    day of a month: smoothed as they are (``macd_gapped``), and after the
    forward fill that the panel applies."""
    gap = F.dayofmonth("date") % 7 == 0
    bars = B.bars_daily(spark, sf_dir).select(*KEYS, *[
        F.when(~gap, F.col(c)).alias(c) for c in ("high", "low", "close", "volume")])
    bars = ewm_mean(ewm_mean(bars, "close", "_s", com=21, adjust=False), "close", "_a", com=20, min_periods=21)
    bars = bars.withColumns({"ewm_plain": F.col("_s"), "ewm_adjusted": F.col("_a")}).drop("_s", "_a")
    w = panel_window()
    filled = bars.withColumns({c: ffill(c, w) for c in ("high", "low", "close", "volume")})
    out = I.obv(I.stochastic(I.bollinger(I.macd(I.rsi(filled)))))
    return round_cols(out.select(*KEYS, "ewm_plain", "ewm_adjusted", *I.TECHNICAL))


# ------------------------------------------------------------------ steps 2-3
@query("returns_lagged")
def returns_lagged(spark, sf_dir):
    return _price(spark, sf_dir, ["return_1m"])


@query("sma_ratio")
def sma_ratio(spark, sf_dir):
    return _price(spark, sf_dir, ["sma_50", "sma_200", "sma_ratio"])


@query("volatility")
def volatility(spark, sf_dir):
    return _price(spark, sf_dir, ["volatility_3m", "volatility_12m"])


@query("sharpe")
def sharpe(spark, sf_dir):
    return _price(spark, sf_dir, ["sharpe_3m"])


@query("avg_volume")
def avg_volume(spark, sf_dir):
    return _price(spark, sf_dir, ["avg_volume_3m", "volume_volatility"])


@query("lagged_returns")
def lagged_returns(spark, sf_dir):
    return _price(spark, sf_dir, ["lag_ret_1", "lag_ret_5", "lag_ret_10"])


@query("price_vs_sma")
def price_vs_sma(spark, sf_dir):
    return _price(spark, sf_dir, ["price_vs_sma50", "price_vs_sma200"])


@query("max_drawdown")
def max_drawdown(spark, sf_dir):
    return _price(spark, sf_dir, ["max_drawdown_3m"])


@query("skew_kurt")
def skew_kurt(spark, sf_dir):
    return _price(spark, sf_dir, ["skew_3m", "kurt_3m"])


# ------------------------------------------------------------------ step 4
@query("forward_return")
def forward_return(spark, sf_dir):
    out = L.forward_return(B.bars_daily(spark, sf_dir))
    return round_cols(out.select(*KEYS, "close", "target_3m_raw"))


@query("yearly_label")
def yearly_label(spark, sf_dir):
    out = L.yearly_quantile_label(B.bars_daily(spark, sf_dir), keep_threshold=True)
    return round_cols(out.select(*KEYS, F.year("date").alias("year"), "threshold",
                                 "target_3m"))


@query("label_distribution")
def label_distribution(spark, sf_dir):
    lab = L.yearly_quantile_label(B.bars_daily(spark, sf_dir))
    return round_cols(L.label_distribution(lab))


# ------------------------------------------------------------------ step 5


@query("rsi")
def rsi(spark, sf_dir):
    return round_cols(I.rsi(B.bars_daily(spark, sf_dir)).select(*KEYS, "rsi"))


@query("macd")
def macd(spark, sf_dir):
    out = I.macd(B.bars_daily(spark, sf_dir))
    return round_cols(out.select(*KEYS, "macd", "macd_signal", "macd_indicator"))


@query("bollinger")
def bollinger(spark, sf_dir):
    out = I.bollinger(B.bars_daily(spark, sf_dir))
    return round_cols(out.select(*KEYS, "upper_bollinger", "lower_bollinger"))


@query("stochastic")
def stochastic(spark, sf_dir):
    out = I.stochastic(B.bars_daily(spark, sf_dir))
    return round_cols(out.select(*KEYS, "stochastic_d", "stochastic_k"))


@query("obv")
def obv(spark, sf_dir):
    return round_cols(I.obv(B.bars_daily(spark, sf_dir)).select(*KEYS, "obv"))


# ------------------------------------------------------------------ step 6


@query("vix_features")
def vix_features(spark, sf_dir):
    return round_cols(M.vix_features(SM.macro_daily(spark, sf_dir)))


@query("yield_features")
def yield_features(spark, sf_dir):
    return round_cols(M.yield_features(SM.macro_daily(spark, sf_dir)))


@query("cpi_features")
def cpi_features(spark, sf_dir):
    return round_cols(M.cpi_features(SM.macro_monthly(spark, sf_dir)))


@query("macro_calendar")
def macro_calendar(spark, sf_dir):
    return round_cols(M.build_macro(*SM.macro_series(spark, sf_dir)))


# ------------------------------------------------------------------ step 8

BENCHMARK = "AMERICA"
BENCHMARKS = ["AMERICA", "EUROPE"]


@query("forward_fill")
def forward_fill(spark, sf_dir):
    bars = B.bars_daily(spark, sf_dir)
    out = RS.align_benchmarks(bars, None, [BENCHMARK])
    return round_cols(out.select(*KEYS, F.col("_b0").alias("bench_close"),
                                 F.col("_bf0").alias("bench_close_ffill")))


@query("relative_strength")
def relative_strength(spark, sf_dir):
    out = RS.relative_strength(B.bars_daily(spark, sf_dir), BENCHMARKS)
    return round_cols(out.select(*KEYS, *[RS.rs_name(b) for b in BENCHMARKS]))


# ------------------------------------------------------------------ step 10

SPLIT_DATE = "1999-01-01"
#: Training labels look 63 rows ahead.
EMBARGO_ROWS = 63


def _labelled_split(spark, sf_dir):
    lab = L.yearly_quantile_label(B.bars_daily(spark, sf_dir))
    return S.temporal_split(lab, SPLIT_DATE)


@query("train_test_split")
def train_test_split(spark, sf_dir):
    return _labelled_split(spark, sf_dir).select(*KEYS, "split")


@query("walk_forward_folds")
def walk_forward_folds(spark, sf_dir):
    train = _labelled_split(spark, sf_dir).where(F.col("split") == "train")
    return S.walk_forward_folds(train).select(*KEYS, "row_idx", "test_fold")


@query("recency_weights")
def recency_weights(spark, sf_dir):
    train = _labelled_split(spark, sf_dir).where(F.col("split") == "train")
    return round_cols(S.recency_weights(train).select(*KEYS, "weight"))


@query("class_balance")
def class_balance(spark, sf_dir):
    train = _labelled_split(spark, sf_dir).where(F.col("split") == "train")
    return round_cols(S.class_balance(train))


# ------------------------------------------------------------------ step 11


def _scored(spark, sf_dir, reused=False):
    """Deterministic score for the evaluation operators: the (shifted)
    stochastic %K rescaled to [0, 1], against the yearly label.  When the
    caller reads it twice (train sweep + test predictions) it is
    materialised once instead of recomputing bars, labels and %K."""
    st = I.stochastic(_labelled_split(spark, sf_dir))
    sc = st.select(*KEYS, F.col("target_3m").alias("label"),
                   (F.col("stochastic_k") / F.lit(100.0)).alias("p"), "split") \
           .where(F.col("p").isNotNull() & F.col("split").isNotNull())
    return materialize(sc) if reused else sc


def _test_pred(spark, sf_dir):
    sc = _scored(spark, sf_dir, reused=True)
    best = E.best_threshold(sc.where(F.col("split") == "train"))
    # a symbol without scored training rows keeps its test rows, at 0.5
    test = sc.where(F.col("split") == "test").join(best, "symbol", "left")
    return E.predict(test.fillna({"threshold": 0.5}), "threshold")


@query("threshold_sweep")
def threshold_sweep(spark, sf_dir):
    sc = _scored(spark, sf_dir).where(F.col("split") == "train")
    return round_cols(E.threshold_sweep(sc))


@query("confusion")
def confusion(spark, sf_dir):
    return E.confusion(_test_pred(spark, sf_dir))


@query("classification_report")
def classification_report(spark, sf_dir):
    return round_cols(E.classification_report(_test_pred(spark, sf_dir)))


@query("accuracy")
def accuracy(spark, sf_dir):
    pr = _test_pred(spark, sf_dir)
    return round_cols(E.accuracy(pr).join(E.f1_score(pr), "symbol"))


@query("roc_auc")
def roc_auc(spark, sf_dir):
    sc = _scored(spark, sf_dir).where(F.col("split") == "test")
    return round_cols(E.roc_auc(sc))


def _panel_corr(spark, sf_dir):
    """Correlation of every model input with the label, on training rows."""
    panel = shared(spark, "split_panel_zero", panel_tables(sf_dir), lambda: S.temporal_split(
        build_panel(spark, sf_dir), SPLIT_DATE))
    train = panel.where(F.col("split") == "train")
    return E.label_correlation(train, PN.feature_columns(train))


@query("feature_label_corr")
def feature_label_corr(spark, sf_dir):
    return round_cols(_panel_corr(spark, sf_dir))


@query("mean_corr")
def mean_corr(spark, sf_dir):
    return round_cols(E.mean_correlation(_panel_corr(spark, sf_dir)))


# ------------------------------------------------------------------ step 7

ALL_ITEMS = sorted({i for _, i, _ in ST.ITEM_SPECS} | {i for _, i, _ in ST.TEXT_ITEMS}
                   | {r for r, _, _ in FU.RATIOS})


def _parsed(spark, sf_dir):
    """Parsed statements, materialised once: every fundamentals operator
    reads them in several branches."""
    return materialize(ST.parse_statements(ST.statements_from_orders(spark, sf_dir)))


@query("statement_items")
def statement_items(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return round_cols(p.where(F.col("item").isNotNull()))


@query("fundamental_ratios")
def fundamental_ratios(spark, sf_dir):
    p = _parsed(spark, sf_dir).where(F.col("item").isNotNull())
    return round_cols(FU.statement_ratios(p))


@query("null_ratio_filter")
def null_ratio_filter(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    d = FU.with_ratios(p.where(F.col("item").isNotNull())).unionByName(
        p.where(F.col("item").isNull()))
    return round_cols(FU.null_ratios(d))


@query("log_scale")
def log_scale(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    d = FU.with_ratios(p.where(F.col("item").isNotNull())).unionByName(
        p.where(F.col("item").isNull()))
    return round_cols(FU.log_scale(FU.drop_sparse(d)))


@query("statement_dedup")
def statement_dedup(spark, sf_dir):
    return FU.fundamentals_long(_parsed(spark, sf_dir)).select(
        "symbol", "item", "statement").distinct()


@query("fundamentals_asof")
def fundamentals_asof(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    long = FU.fundamentals_long(p)
    bars = B.bars_daily(spark, sf_dir).select(*KEYS)
    out = FU.asof_fundamentals(bars, long, ST.report_dates(p), ALL_ITEMS)
    return round_cols(out.select(*KEYS, "fiscal_date", *ALL_ITEMS))


@query("quarterly_growth")
def quarterly_growth(spark, sf_dir):
    return round_cols(FU.quarterly_growth(spark, _parsed(spark, sf_dir)))


@query("first_available_alias")
def first_available_alias(spark, sf_dir):
    p = _parsed(spark, sf_dir).where(F.col("item").isNotNull())
    return round_cols(FU.first_available(spark, p))


# ------------------------------------------------------------------ step 9


def panel_tables(sf_dir):
    return [f"{sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer", "supplier", "nation", "region")]


def build_panel(spark, sf_dir, tail="zero"):
    """The flagship panel from the landed tables: bars, macro calendar,
    statements and two benchmarks.  The three small inputs are materialised
    once (each feeds several branches of the plan)."""
    bars = B.bars_daily(spark, sf_dir, written=True)
    macro = materialize(M.build_macro(*SM.macro_series(spark, sf_dir)))
    return PN.feature_panel(bars, macro, _parsed(spark, sf_dir), BENCHMARKS,
                            items=ALL_ITEMS, tail=tail)


@query("feature_panel")
def feature_panel(spark, sf_dir):
    return round_cols(build_panel(spark, sf_dir))


# ------------------------------------------------------------------ step 12

def split_panel(spark, sf_dir):
    """Training panel (tail labels NULL, not 0), split, written once a session."""
    return shared(spark, "split_panel", panel_tables(sf_dir), lambda: S.temporal_split(
        build_panel(spark, sf_dir, tail="null"), SPLIT_DATE))


@query("training_frame")
def training_frame(spark, sf_dir):
    """What the classifier is trained on: label, weight (recency
    times class scale) and the flags of missing inputs, after the embargo."""
    panel = split_panel(spark, sf_dir)
    feats = PN.feature_columns(panel)
    train, flags = T.add_missing_flags(T.training_frame(panel, feats, embargo_rows=EMBARGO_ROWS), feats)
    return round_cols(train.select(*KEYS, "label", "weight",
                                   *[F.col(f).cast("int").alias(f) for f in flags]))


@query("features_round_trip")
def features_round_trip(spark, sf_dir):
    """The labelled price features, written partitioned by symbol and read
    back from there."""
    lab = P.price_features(B.bars_daily(spark, sf_dir))
    path = T.write_features(lab, f"{ensure_checkpoint_dir(spark)}/features-{uuid.uuid4().hex}")
    return round_cols(spark.read.parquet(path).select(*KEYS, "close", *P.PRICE_FEATURES))


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    """M3 + M7: the model of the fall-back parameters (500 rounds)."""
    panel = split_panel(spark, sf_dir)
    feats = PN.feature_columns(panel)
    train = T.training_frame(panel, feats, embargo_rows=EMBARGO_ROWS)
    feats = T.usable_features(train, feats)
    model = T.fit_gbt(train, feats)
    cut = T.tuned_cutoffs(model, train, feats)
    test = (panel.where((F.col("split") == "test") & F.col("target_3m").isNotNull())
            .withColumn("label", F.col("target_3m").cast("double")))
    return round_cols(T.scores_with_cutoff(model, test, feats, cut))


@query("pooled_report")
def pooled_report(spark, sf_dir):
    """M9 + A4: confusion cells of the fixed-parameter pass (500 rounds)."""
    panel = split_panel(spark, sf_dir)
    feats = PN.feature_columns(panel)
    feats = T.usable_features(T.training_frame(panel, feats, embargo_rows=EMBARGO_ROWS), feats)
    cells, _ = T.pooled_report(panel, feats, embargo_rows=EMBARGO_ROWS)
    return cells


# A cut-down search for the registered query: two sampled parameter sets, two
# pooled walk-forward folds.  The full space and budget (40 draws, 5 folds) are
# the defaults of tickwise.operators.train.random_search.
SEARCH_SPACE_SMALL = {"maxIter": [5, 10], "stepSize": [0.1], "maxDepth": [3, 4],
                      "subsamplingRate": [0.8], "minInstancesPerNode": [3]}


@query("gbt_search")
def gbt_search(spark, sf_dir):
    """M4 + M7: random search over walk-forward folds, refit of the best
    parameters, scores of the test rows at the tuned per-symbol cut-offs."""
    panel = split_panel(spark, sf_dir)
    feats = PN.feature_columns(panel)
    train = T.training_frame(panel, feats, embargo_rows=EMBARGO_ROWS)
    feats = T.usable_features(train, feats)
    best, _, model = T.random_search(train, feats, SEARCH_SPACE_SMALL, n_iter=2, n_splits=2,
                                     parallelism=2, embargo_rows=EMBARGO_ROWS)
    cut = T.tuned_cutoffs(model, train, feats)
    test = (panel.where((F.col("split") == "test") & F.col("target_3m").isNotNull())
            .withColumn("label", F.col("target_3m").cast("double")))
    out = T.scores_with_cutoff(model, test, feats, cut)
    return round_cols(out.withColumn("best_max_iter", F.lit(int(best["maxIter"])))
                         .withColumn("best_max_depth", F.lit(int(best["maxDepth"]))))


@query("oof_cutoffs")
def oof_cutoffs(spark, sf_dir):
    """M6 on unseen rows: cut-offs per symbol from scores of walk-forward folds,
    each fitted (20 rounds) on the dates before it."""
    panel = split_panel(spark, sf_dir)
    train = T.training_frame(panel, PN.feature_columns(panel), embargo_rows=EMBARGO_ROWS)
    feats = T.usable_features(train, PN.feature_columns(panel))
    cut = T.out_of_fold_cutoffs(train, feats, T.DEFAULT_PARAMS | {"maxIter": 20}, n_splits=3, embargo_rows=EMBARGO_ROWS)
    return round_cols(cut)


# Models of a few rounds, for what SQL can tell about a fit: which rows are trained
# on and scored, and bounds that any fit with real trees keeps.
FEW_ROUNDS = T.DEFAULT_PARAMS | {"maxIter": 20}
#: Least ROC AUC on the rows that a model was trained on.
LEAST_AUC = 0.7


def _train_and_test(spark, sf_dir):
    """Training rows, labelled test rows and the inputs seen in training."""
    panel = split_panel(spark, sf_dir)
    feats = PN.feature_columns(panel)
    train = T.training_frame(panel, feats, embargo_rows=EMBARGO_ROWS)
    test = (panel.where((F.col("split") == "test") & F.col("target_3m").isNotNull())
            .withColumn("label", F.col("target_3m").cast("double")))
    return train, test, T.usable_features(train, feats)


def _learned(scores):
    """Per symbol the scored training rows, and whether their AUC is over the bound."""
    counts = scores.where(F.col("p").between(0, 1)).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_train"))
    aucs = E.roc_auc(scores).select("symbol", (F.col("auc") >= LEAST_AUC).alias("learned"))
    return counts.join(aucs, "symbol")


@query("model_round_trip")
def model_round_trip(spark, sf_dir):
    """S6 + M7: a pooled model (20 rounds) written to the shared folder and loaded
    again: per symbol the test rows, those with a probability from the loaded
    model, and those where it equals the first model's."""
    train, test, feats = _train_and_test(spark, sf_dir)
    model = T.fit_gbt(train, feats, FEW_ROUNDS)
    path = T.save_model(model, f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}")
    before = T.score(model, test, feats).select(*test.columns, F.col("p").alias("before"))
    both = T.score(T.load_model(path), before, feats)
    return both.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("p").between(0, 1)).alias("n_scored"),
        F.count_if(F.col("p") == F.col("before")).alias("n_same"))


@query("symbol_models")
def symbol_models(spark, sf_dir):
    """M8: a model (20 rounds) per symbol: its training rows, whether it tells them
    apart, and the test rows that it gives a probability."""
    train, test, feats = _train_and_test(spark, sf_dir)
    models = T.fit_per_symbol(train, feats, FEW_ROUNDS)
    scored = T.score_per_symbol(models, test).where(F.col("p").between(0, 1))
    tested = scored.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_test"))
    return _learned(T.score_per_symbol(models, train)).join(tested, "symbol", "left")


@query("model_bounds")
def model_bounds(spark, sf_dir):
    """M3 + M9 + A4: the pooled model (20 rounds): per symbol its training rows and
    whether it tells them apart, and the test rows in the confusion cells of the
    fixed-parameter pass."""
    train, _, feats = _train_and_test(spark, sf_dir)
    train = materialize(train)
    scores = materialize(T.score(T.fit_gbt(train, feats, FEW_ROUNDS), train, feats).select("symbol", "label", "p"))
    cells, _ = T.pooled_report(split_panel(spark, sf_dir), feats, FEW_ROUNDS, embargo_rows=EMBARGO_ROWS)
    tested = cells.groupBy("symbol").agg(F.sum("n").cast("bigint").alias("n_test"))
    return _learned(scores).join(tested, "symbol", "left")


from . import catalog_long  # noqa: E402  more queries, registered here

QUERIES.update(catalog_long.QUERIES)
