"""Temporal split, walk-forward folds,
recency weights and class balance -- all per symbol, all lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import panel_window
from ..functions.frames import distributed_index


def temporal_split(df: DataFrame, split_date: str = "2021-01-01", key="symbol",
                   order="date", parity: bool = True, embargo_rows: int = 0) -> DataFrame:
    """Add ``split`` in {'train', 'test', NULL}.

    Test rows are ``date >= split_date``.  With ``parity=True`` the training
    slice is ``date <= split_date`` minus its last row per symbol (the row is
    dropped even when the split date has no bar; such a row is in neither
    set, hence NULL).  ``parity=False`` trains on ``date < split_date``.
    ``embargo_rows`` additionally removes that many training rows before the
    split, since labels look ahead.
    """
    sd = F.lit(split_date).cast("date")
    d = F.col(order).cast("date")
    cand = (d <= sd) if parity else (d < sd)
    back = Window.partitionBy(key, cand).orderBy(F.col(order).desc())
    drop = (1 if parity else 0) + embargo_rows
    rn = F.row_number().over(back)
    split = (F.when(d >= sd, F.lit("test"))
             .when(cand & (rn > F.lit(drop)), F.lit("train")))
    return df.withColumn("split", split)


def walk_forward_folds(train: DataFrame, n_splits: int = 5, key="symbol",
                       order="date") -> DataFrame:
    """M2: expanding-window folds over each symbol's training rows.

    With ``n`` rows and ``ts = n // (n_splits + 1)``, fold ``k`` tests rows
    ``[n - (n_splits-k)*ts, n - (n_splits-k-1)*ts)`` and trains on every
    earlier row.  Adds ``row_idx`` (0-based) and ``test_fold`` (-1 for rows
    that only ever train); fold ``k``'s training set is
    ``row_idx < n - (n_splits-k)*ts``.
    """
    w = panel_window(key, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    d = (train.withColumn("row_idx", (F.row_number().over(w) - 1).cast("bigint"))
              .withColumn("_n", n.cast("bigint")))
    ts = F.floor(F.col("_n") / F.lit(n_splits + 1))
    first = F.col("_n") - F.lit(n_splits) * ts
    fold = F.when((ts > 0) & (F.col("row_idx") >= first),
                  F.floor((F.col("row_idx") - first) / ts)).otherwise(F.lit(-1))
    return d.withColumn("test_fold", fold.cast("int")).drop("_n")


def pooled_walk_forward_folds(train: DataFrame, n_splits: int = 5, order="date") -> DataFrame:
    """M2 for a pooled model: folds cut on the calendar of distinct training
    dates, so no symbol's later dates train another symbol's earlier test
    fold.  The calendar (one row per date) is numbered once without a
    single-partition window (:func:`distributed_index`) and joined back."""
    cal = distributed_index(train.select(order).distinct(), order, "date_idx")
    cal = cal.withColumn("_n", F.lit(cal.count()).cast("bigint"))
    ts = F.floor(F.col("_n") / F.lit(n_splits + 1))
    first = F.col("_n") - F.lit(n_splits) * ts
    cal = cal.withColumn("test_fold", F.when((ts > 0) & (F.col("date_idx") >= first),
                                             F.floor((F.col("date_idx") - first) / ts))
                         .otherwise(F.lit(-1)).cast("int")).drop("_n")
    return train.join(cal, order, "left")


def recency_weights(train: DataFrame, decay: float = 0.99, unit_days: float = 30.0,
                    key="symbol", order="date", out="weight") -> DataFrame:
    """``decay ** (age_days / unit_days)`` against the newest training date
    of the symbol."""
    newest = F.max(order).over(Window.partitionBy(key))
    age = F.datediff(newest, F.col(order)).cast("double")
    return train.withColumn(out, F.pow(F.lit(decay), age / F.lit(unit_days)))


def class_balance(train: DataFrame, label="target_3m", key="symbol") -> DataFrame:
    """A3: positives, negatives and ``negatives / max(positives, 1)``."""
    y = F.col(label)
    return train.groupBy(key).agg(
        F.sum(y).cast("bigint").alias("positives"),
        (F.count(y) - F.sum(y)).cast("bigint").alias("negatives"),
    ).withColumn("pos_scale", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)))


def scale_positive_weights(train: DataFrame, label="target_3m", key="symbol",
                           weight="weight") -> DataFrame:
    """M5: multiply the weight of positive rows by the symbol's class scale
    (window aggregates on the existing ``symbol`` partitioning, no join)."""
    part = Window.partitionBy(key)
    pos = F.sum(F.col(label)).over(part)
    neg = F.count(F.col(label)).over(part) - pos
    scale = neg / F.greatest(pos, F.lit(1))
    w0 = F.col(weight) if weight in train.columns else F.lit(1.0)
    return train.withColumn(weight, F.when(F.col(label) == 1, w0 * scale).otherwise(w0))
