"""Sharding by longest-processing-time scheduling (LPT).

Rows that must stay together form a group; the groups, largest first, go to
the least-loaded shard of a heap.  Groups of one size are interchangeable for
that schedule, so the heap works on the histogram of group sizes: c groups of
one size are dealt in one step, exactly as the heap would deal them one after
another.  Only the histogram passes through the driver, and it is bounded:
sizes up to 64 KiB are exact (65,536 entries at most), larger ones share a
class with sizes that differ by less than a thousandth (1,024 a power of two).
Within its size class a group has a number, given by a distributed count, and
the number decides the shard.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import quoted, spare

EXACT_SIZES = 1 << 16
#: Rows that one task numbers.
NUMBERED_ROWS = 5_000


def number(df: DataFrame, key: str, order: list, out: str, rows: int) -> DataFrame:
    """``df`` plus ``out``: gapless numbers from 0 within each ``key``, for a
    table of about ``rows`` rows.

    Each key is split by a hash of the order columns, so that a key with most
    rows is numbered by many tasks; a part starts where the parts before it
    end.
    """
    part, n, at, own = (spare(df.columns) + c for c in ("part", "n", "at", "own"))
    parts = max(1, math.ceil(rows / NUMBERED_ROWS))
    split = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = split.groupBy(key, part).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(at))
    numbered = F.row_number().over(Window.partitionBy(key, part).orderBy(*order)) - 1
    return (split.withColumn(own, numbered).join(starts, [key, part])
            .withColumn(out, (F.col(at) + F.col(own)).cast("long")).drop(part, own, at))


def deal(histogram: list[tuple[int, float, int]], shards: int) -> list[tuple[int, list[int]]]:
    """LPT over (class, size, count), largest size first: for each class, up to
    which number its groups go to shard 0, 1 and so on."""
    loads = [0.0] * shards
    out = []
    for kind, size, count in sorted(histogram, key=lambda x: (-x[1], x[0])):
        # All that the heap would place below a level, found by halving ...
        low, high = min(loads), max(loads) + size * count
        under = lambda level: [max(0, math.ceil((level - x) / size)) for x in loads]  # noqa: E731,B023
        for _ in range(64):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(under(middle)) <= count else (low, middle)
        dealt = under(low)
        if sum(dealt) > count:
            dealt = [0] * shards
        # ... and the few that are left, from the heap itself.
        heap = [(x + n * size, j) for j, (x, n) in enumerate(zip(loads, dealt))]
        heapq.heapify(heap)
        for _ in range(count - sum(dealt)):
            load, j = heapq.heappop(heap)
            dealt[j] += 1
            heapq.heappush(heap, (load + size, j))
        loads = [x + n * size for x, n in zip(loads, dealt)]
        ends, at = [], 0
        for n in dealt:
            ends.append(at := at + n)
        out.append((kind, ends))
    return out


def size_class(size: Column) -> Column:
    """The size itself up to EXACT_SIZES, else its first eleven binary digits."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(size)) - 11)
    return F.when(size <= EXACT_SIZES, size).otherwise(size - size % step)


def shard_groups(rows: DataFrame, group: str, size: str, shards: int = 8) -> DataFrame:
    """``rows`` plus ``shard`` and ``slot``: rows of one ``group`` share a shard,
    the shards' sums of ``size`` (positive) are near equal, and the slots of a
    shard run from 0 without gaps.

    ``rows`` should be thin (it is read three times).  Equal rows get slots of
    their own; an empty table gives an empty result.  Null is a group as well.
    Other columns pass through, whatever their names; columns ``shard`` and ``slot``
    are replaced, even one that is the group or the size.
    """
    rest = [c for c in rows.columns if c not in ("shard", "slot")]
    same, weight = (spare(rows.columns) + c for c in ("same", "weight"))
    rows = rows.select(*quoted(rest), F.col(group).alias(same), F.col(size).alias(weight))
    order = quoted(rest) + [own for name, own in ((group, same), (size, weight)) if name not in rest]
    groups = materialize(rows.groupBy(F.col(same).alias("__group"))
                         .agg(F.sum(weight).alias("__sum"), F.count(F.lit(1)).alias("__rows"))
                         .withColumn("__class", size_class(F.col("__sum"))))
    histogram = groups.groupBy("__class").agg(F.avg("__sum"), F.count(F.lit(1)), F.sum("__rows")).collect()
    spark = rows.sparkSession
    ends = spark.createDataFrame(deal([tuple(r)[:3] for r in histogram], shards),
                                 "__class long, __ends array<long>")
    n_groups, n_rows = sum(r[2] for r in histogram), sum(r[3] for r in histogram)
    placed = (number(groups, "__class", [F.col("__group")], "__no", n_groups)
              .join(F.broadcast(ends), "__class")
              .select(F.col("__group").alias(f"{same}_"),
                      F.size(F.filter("__ends", lambda e: e <= F.col("__no"))).alias("shard")))
    joined = rows.join(placed, F.col(same).eqNullSafe(F.col(f"{same}_"))).drop(f"{same}_")
    return number(joined, "shard", [F.col(c) for c in order], "slot", n_rows).drop(same, weight)
