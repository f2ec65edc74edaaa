"""DataFrame-level time-series helpers: daily densification and forward
fill along a calendar that has no partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import POS, SLICE, numbered, segmented_scan


def densify_daily(df: DataFrame, order: str = "date", key: str | list[str] | None = None,
                  until_next: bool = True) -> DataFrame:
    """pandas ``resample("D").ffill()`` for a sparse (monthly, quarterly) table.

    Each row is repeated for every day from its date up to the day before the
    next row's date (its validity interval); the last row covers its own day
    only, as the resampled index ends at the last observation.  Values are
    carried row-wise, so a NULL inside a row stays NULL for its interval.
    Every row explodes into at most (gap in days) rows -- no cross join and no
    global sort; the ``lead`` runs per ``key`` (or over the calendar).
    """
    keys = [] if key is None else ([key] if isinstance(key, str) else list(key))
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
    nxt = F.lead(order, 1).over(w)
    end = F.coalesce(F.date_sub(nxt, 1), F.col(order)) if until_next else F.col(order)
    cols = [c for c in df.columns if c != order]
    return (df.select(*cols, F.col(order).alias("_from"), end.alias("_to"))
              .select(*cols, F.explode(F.sequence("_from", "_to")).alias(order)))


def ffill_by_time(df: DataFrame, cols: list[str], order: str = "date",
                  bucket=None) -> DataFrame:
    """Forward fill ``cols`` along ``order`` for a table without a partition key
    (a calendar), without moving the table into one task.

    Time buckets (calendar years by default) are the slices of a segmented scan
    (:mod:`.slices`): each is filled on its own, and only a summary with one row
    per bucket is ordered globally.
    """
    bucket = bucket if bucket is not None else F.year(F.col(order))
    return (segmented_scan(df.withColumn("_bk", bucket), {c: ("last", c) for c in cols}, [], order, "_bk", written=True)
            .select(*df.columns))


def distributed_index(df: DataFrame, order: str, out: str = "idx") -> DataFrame:
    """0-based position of each row in ``order`` (distinct values), without
    moving the table into one partition.

    Rows are numbered inside range slices; a slice's offset is the number of rows
    in earlier ones (:func:`.slices.numbered`).
    """
    return numbered(df, [], order).withColumn(out, F.col(POS).cast("bigint")).drop(POS, SLICE)
