"""Interval (as-of) join: attach to each point the interval ``[start, end)``
of the same key that contains it.

Spark has no as-of join, and an equi-join on the key alone sends every
point of a hot key to one task and compares it with every interval of that
key.  Instead each interval is exploded into the calendar months it
overlaps (an interval of d days yields about d/30 rows), points get their
own month, and the join is an equi-join on ``(key, month)`` plus the range
predicate: each point meets only the one or two intervals of its month, and
a hot key is spread over its months.  The planner chooses broadcast or
shuffle by the measured size of the interval side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.slices import SLICE, names, segmented_scan, sliced


def interval_join(points: DataFrame, intervals: DataFrame, key: str | list[str],
                  point_col: str, start_col: str, end_col: str, how: str = "left",
                  bucket: str = "month") -> DataFrame:
    """Join ``points`` to non-overlapping ``intervals`` on ``key`` with
    ``start <= point < end`` (dates).  ``end`` must be non-null."""
    keys = [key] if isinstance(key, str) else list(key)
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    first_b = F.trunc(F.col(start_col), bucket)
    last_b = F.trunc(F.date_sub(F.col(end_col), 1), bucket)
    iv = intervals.where(F.col(end_col) > F.col(start_col)).withColumn(
        "_bk", F.explode(F.sequence(first_b, last_b, step)))
    pts = points.withColumn("_bk", F.trunc(F.col(point_col), bucket))
    cond = [pts[k] == iv[k] for k in keys] + [
        pts["_bk"] == iv["_bk"],
        iv[start_col] <= pts[point_col], pts[point_col] < iv[end_col]]
    out = pts.join(iv, cond, how)
    keep = [pts[c] for c in points.columns] + [
        iv[c] for c in intervals.columns if c not in keys and c not in points.columns]
    return out.select(*keep)


def asof_join(points: DataFrame, reports: DataFrame, key: str | list[str], point_col: str, report_col: str,
              strict: bool = False) -> DataFrame:
    """Attach to each point the latest report of its key at or before it (before
    it, if ``strict``), at the grain of the columns (timestamps or dates).

    Points and reports are laid into one table in the order of time, and each
    point takes the last report so far.  That is a segmented scan: a hot key lies
    in many range slices, and no point is compared with a list of reports.
    Points without a report, or without a time, keep nulls; of several reports
    at one time the one that sorts last by its columns counts.
    """
    keys = names(key)
    payload = [c for c in reports.columns if c not in keys]
    held = F.struct(F.col(report_col).alias("_t"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(payload)])
    none = F.lit(None)
    kind = reports.select(held.alias("h")).schema["h"].dataType
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    rows = points.select(*keys, F.col(point_col).alias("_at"), F.lit(0 if strict else 1).alias("_side"),
                         none.cast(kind).alias("_report"), row.alias("_row"))
    own = points.select(row.alias("r")).schema["r"].dataType
    more = (reports.where(F.col(report_col).isNotNull())
            .select(*keys, F.col(report_col).alias("_at"), F.lit(1 if strict else 0).alias("_side"), held.alias("_report"),
                    none.cast(own).alias("_row")))
    # A time's reports come as one row: the one that sorts last.
    more = more.groupBy(*keys, "_at", "_side").agg(F.max("_report").alias("_report")).withColumn("_row", none.cast(own))
    both = sliced(rows.unionByName(more.select(rows.columns)), keys, ["_at", "_side"])
    known = F.when(F.col("_at").isNotNull(), F.col("_report"))
    scanned = segmented_scan(both, {"_last": ("last", known)}, keys, ["_at", "_side"], written=True)
    last = F.when(F.col("_at").isNotNull(), F.col("_last"))
    return (scanned.where("_row is not null").drop(SLICE)
            .select("_row.*", *[last[f"_p{i}"].alias(c) for i, c in enumerate(payload)]))
