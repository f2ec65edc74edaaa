"""Forward return, yearly-quantile growth label and
the label distribution report.

The label of a day is 1 when its ``horizon``-row forward return is above the
``q`` quantile (linear interpolation, missing skipped) of all forward
returns of the same symbol in the same calendar year.  The quantile is the
exact ``percentile`` aggregate over ``partitionBy(symbol, year)``; that
clustering is satisfied by the hash partitioning on ``symbol`` the other
windows already use, so it adds a sort but no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flag, panel_window, safe_div


def forward_return(df: DataFrame, horizon: int = 63, key="symbol", order="date",
                   price="close") -> DataFrame:
    """``target_3m_raw = close[t+horizon] / close[t] - 1`` (NULL in the tail)."""
    w = panel_window(key, order)
    return df.withColumn(
        "target_3m_raw",
        safe_div(F.lead(price, horizon).over(w), F.col(price)) - F.lit(1.0))


def yearly_quantile_label(df: DataFrame, horizon: int = 63, q: float = 0.6,
                          tail: str = "zero", key="symbol", order="date",
                          keep_threshold: bool = False) -> DataFrame:
    """Add ``target_3m_raw`` and ``target_3m``.

    ``tail="zero"`` reproduces the reference: a day without a known future
    (the last ``horizon`` rows) is labelled 0 because a missing value is not
    greater than the threshold.  ``tail="null"`` leaves those labels NULL,
    which is what training should use.
    """
    if tail not in ("zero", "null"):
        raise ValueError("tail must be 'zero' or 'null'")
    out = forward_return(df, horizon, key, order)
    yw = Window.partitionBy(key, F.year(order))
    out = out.withColumn("_thr", F.percentile(F.col("target_3m_raw"), F.lit(q)).over(yw))
    cond = F.col("target_3m_raw") > F.col("_thr")
    label = flag(cond) if tail == "zero" else cond.cast("int")
    out = out.withColumn("target_3m", label)
    if keep_threshold:
        return out.withColumnRenamed("_thr", "threshold")
    return out.drop("_thr")


def label_distribution(labelled: DataFrame, key="symbol", order="date",
                       label="target_3m") -> DataFrame:
    """A2: per symbol, counts and shares of each class, the 1s ratio,
    the number of samples and the covered period (one row per symbol)."""
    y = F.col(label)
    return labelled.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_neg"),
        (F.sum(y) / F.count(F.lit(1))).alias("ratio_pos"),
        F.avg(F.when(y.isNotNull(), (y == 0).cast("double"))).alias("share_neg"),
        F.avg(F.when(y.isNotNull(), (y == 1).cast("double"))).alias("share_pos"),
        F.min(order).alias("first_date"),
        F.max(order).alias("last_date"),
    )
