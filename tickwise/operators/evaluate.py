"""Evaluation of scored rows
``(symbol, date, label, p)``.

Everything is computed from grouped counts, never by sorting all rows
together: the threshold sweep buckets each score once, ROC AUC aggregates
ties per distinct score before a running sum, correlations unpivot the
features and aggregate per (symbol, feature) with map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.slices import segmented_scan, sliced

# Fixed values of the reference's cut-off grid (numpy.linspace semantics:
# t_i = i * ((hi - lo) / (n - 1)) + lo, last point exactly hi).
SWEEP_LO, SWEEP_HI, SWEEP_N = 0.05, 0.95, 50


def thresholds(lo: float = SWEEP_LO, hi: float = SWEEP_HI, n: int = SWEEP_N) -> list[float]:
    step = (hi - lo) / (n - 1)
    return [hi if i == n - 1 else i * step + lo for i in range(n)]


def _threshold_at(i, lo, hi, n):
    """Column expression of the i-th grid value (same arithmetic as numpy)."""
    step = (hi - lo) / (n - 1)
    return F.when(i == F.lit(n - 1), F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))


def _bucket(p, lo, hi, n):
    """Number of grid thresholds <= p, exactly (estimate, then one correction
    step each way using the grid's own arithmetic)."""
    step = (hi - lo) / (n - 1)
    est = F.floor((p - F.lit(lo)) / F.lit(step)) + 1
    est = F.least(F.greatest(est, F.lit(0)), F.lit(n))
    up = F.when((est < n) & (p >= _threshold_at(est, lo, hi, n)), est + 1).otherwise(est)
    return F.when((up > 0) & (p < _threshold_at(up - 1, lo, hi, n)), up - 1).otherwise(up)


def threshold_sweep(scored: DataFrame, key="symbol", label="label", score="p",
                    lo: float = SWEEP_LO, hi: float = SWEEP_HI, n: int = SWEEP_N) -> DataFrame:
    """M6: F1 of the positive class at each of ``n`` evenly spaced cut-offs
    (``pred = p >= t``), per symbol; ``is_best`` marks the first maximum
    (lowest threshold on ties), as ``argmax`` does.

    One aggregate over the scored rows -- counts per (symbol, bucket, label)
    -- then cumulative sums over at most ``n + 1`` buckets per symbol.
    """
    b = _bucket(F.col(score), lo, hi, n)
    counts = (scored.where(F.col(score).isNotNull())
              .groupBy(key, b.alias("bucket"))
              .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("n1"),
                   F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("n0")))
    grid = (counts.select(key).distinct()
            .select(key, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("bucket")))
    dense = grid.join(counts, [key, "bucket"], "left").fillna(0, ["n1", "n0"])
    w = (Window.partitionBy(key).orderBy(F.col("bucket").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    allw = Window.partitionBy(key)
    cum = dense.select(key, "bucket",
                       F.sum("n1").over(w).alias("tp"), F.sum("n0").over(w).alias("fp"),
                       F.sum("n1").over(allw).alias("_pos"))
    sweep = (cum.where(F.col("bucket") >= 1)
             .select(key, (F.col("bucket") - 1).alias("t_idx"), "tp", "fp",
                     (F.col("_pos") - F.col("tp")).alias("fn")))
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    sweep = sweep.withColumn("f1", F.when(denom > 0, (2 * F.col("tp")) / denom)
                             .otherwise(F.lit(0.0)))
    sweep = sweep.withColumn("threshold", _threshold_at(F.col("t_idx"), lo, hi, n))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("f1").desc(),
                                                               F.col("t_idx").asc()))
    return sweep.withColumn("is_best", rank == 1).select(
        key, F.col("t_idx").cast("int").alias("t_idx"), "threshold", "tp", "fp", "fn",
        "f1", "is_best")


def best_threshold(scored: DataFrame, key="symbol", label="label", score="p") -> DataFrame:
    """O3: ``(symbol, threshold, f1)`` of the best cut-off."""
    s = threshold_sweep(scored, key, label, score)
    return s.where("is_best").select(key, "threshold", F.col("f1").alias("train_f1"))


def predict(scored: DataFrame, cutoff, score="p", out="pred") -> DataFrame:
    """``pred = p >= cutoff`` (cutoff: number or column name)."""
    c = F.lit(float(cutoff)) if isinstance(cutoff, (int, float)) else F.col(cutoff)
    return scored.withColumn(out, (F.col(score) >= c).cast("int"))


def confusion_counts(pred: DataFrame, key="symbol", label="label", pred_col="pred") -> DataFrame:
    """One row per symbol with tn, fp, fn, tp (conditional sums, zeros kept)."""
    y, p = F.col(label), F.col(pred_col)

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return pred.groupBy(key).agg(
        cnt((y == 0) & (p == 0)).alias("tn"), cnt((y == 0) & (p == 1)).alias("fp"),
        cnt((y == 1) & (p == 0)).alias("fn"), cnt((y == 1) & (p == 1)).alias("tp"))


def confusion(pred: DataFrame, key="symbol", label="label", pred_col="pred",
              total: str = "ALL") -> DataFrame:
    """A4: ``(symbol, label, pred, n)`` -- four cells per symbol, plus the sum
    over symbols under ``symbol = total``."""
    c = confusion_counts(pred, key, label, pred_col)
    tot = c.agg(*[F.sum(x).cast("bigint").alias(x) for x in ("tn", "fp", "fn", "tp")]) \
           .select(F.lit(total).alias(key), "tn", "fp", "fn", "tp")
    both = c.unionByName(tot)
    cells = both.select(key, F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, pred, n)"))
    return cells


def _div0(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, key="symbol", label="label",
                          pred_col="pred") -> DataFrame:
    """A10: precision, recall, F1 and support per class, the accuracy row and
    macro / weighted averages (zero division -> 0)."""
    c = confusion_counts(pred, key, label, pred_col)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    p0, r0, f0 = _div0(tn, tn + fn), _div0(tn, s0), _div0(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = _div0(tp, tp + fp), _div0(tp, s1), _div0(2 * tp, 2 * tp + fp + fn)
    wide = c.select(
        key, s0.alias("s0"), s1.alias("s1"), n.alias("n"),
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"),
        _div0(tn + tp, n).alias("acc"))
    return wide.select(key, F.expr("""stack(5,
        '0', p0, r0, f0, s0,
        '1', p1, r1, f1, s1,
        'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,
        'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,
        'weighted avg', try_divide(p0 * s0 + p1 * s1, n), try_divide(r0 * s0 + r1 * s1, n),
                        try_divide(f0 * s0 + f1 * s1, n), n)
        AS (class_label, precision, recall, f1, support)""")).withColumn(
        "support", F.col("support").cast("bigint"))


def accuracy(pred: DataFrame, key="symbol", label="label", pred_col="pred") -> DataFrame:
    """Share of rows where the prediction equals the label."""
    return pred.groupBy(key).agg(
        F.avg((F.col(label) == F.col(pred_col)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def f1_score(pred: DataFrame, key="symbol", label="label", pred_col="pred") -> DataFrame:
    """Positive-class F1 per symbol (0 when undefined)."""
    c = confusion_counts(pred, key, label, pred_col)
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.select(key, _div0(2 * F.col("tp"), den).alias("f1"))


def roc_auc(scored: DataFrame, key="symbol", label="label", score="p") -> DataFrame:
    """ROC AUC with mid-ranks for ties, per symbol.

    ``AUC = sum_v n1(v) * (N0(< v) + n0(v) / 2) / (P * N)`` over distinct
    scores ``v``.  Ties are aggregated first (one row per symbol and distinct
    score, partial aggregation).  The running count of negatives below each
    score is a segmented scan (:mod:`tickwise.functions.slices`): a symbol with a
    third of all rows is spread over many slices instead of one sorted window
    partition.  NULL when a class is absent.
    """
    ties = (scored.where(F.col(score).isNotNull())
            .groupBy(key, F.col(score).alias("_v"))
            .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("_n1"),
                 F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("double").alias("_n0")))
    d = segmented_scan(sliced(ties, key, "_v"), {"_below": ("sum", "_n0", True)}, key, "_v", written=True)
    below = F.coalesce(F.col("_below"), F.lit(0.0))
    contrib = d.select(key, "_n1", "_n0", (F.col("_n1") * (below + F.col("_n0") / 2)).alias("_c"))
    agg = contrib.groupBy(key).agg(F.sum("_c").alias("_s"), F.sum("_n1").alias("_p"),
                                   F.sum("_n0").alias("_n"))
    return agg.select(key, F.try_divide(F.col("_s"), F.col("_p") * F.col("_n")).alias("auc"),
                      F.col("_p").cast("bigint").alias("n_pos"),
                      F.col("_n").cast("bigint").alias("n_neg"))


def label_correlation(df: DataFrame, features: list[str], key="symbol",
                      label="target_3m") -> DataFrame:
    """Pearson correlation of each feature with the label per symbol,
    pairwise complete; NULL (not an error) for a constant column."""
    y = F.col(label).cast("double")

    def corr(c):
        both = F.col(c).isNotNull() & y.isNotNull()
        x = F.when(both, F.col(c).cast("double"))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(F.when(both, y)))

    def pairs(c):
        return F.count(F.when(F.col(c).isNotNull() & y.isNotNull(), 1)) > 0

    # One pass over the rows; only the row of results per symbol is unpivoted.
    wide = df.groupBy(key).agg(F.array(*[
        F.when(pairs(c), F.struct(F.lit(c).alias("feature"), corr(c).alias("corr"))) for c in features]).alias("_r"))
    return (wide.select(key, F.explode("_r").alias("_r")).where(F.col("_r").isNotNull())
            .select(key, "_r.feature", "_r.corr"))


def mean_correlation(corr: DataFrame) -> DataFrame:
    """Average correlation per feature over symbols, descending."""
    return (corr.groupBy("feature").agg(F.avg("corr").alias("mean_corr"))
            .orderBy(F.col("mean_corr").desc_nulls_last()))

