"""Windows over one very long series without a task that holds all of it.

``Window.partitionBy(symbol)`` sends a symbol to one task.  Here a series is cut
into range slices of successive rows, and what a row needs from other slices is
brought to it:

* a sliding window reaches a bounded number of rows back: each block of rows
  gets copies of the rows before it (:func:`with_halo`);
* a sliding extreme over k rows comes from running extremes of blocks of k
  rows, forwards and backwards (:func:`sliding_extreme`), O(n) whatever k is;
* a running sum, count, extreme or last value has an associative carry: each
  slice is scanned on its own, and a table with one row per slice gives what the
  earlier ones come to (:func:`segmented_scan`);
* an exponentially weighted mean decays: the carry is the weighted sum of the
  preceding block alone, older rows weigh less than a double can show
  (:func:`ewm_scan`).

The only windows over a whole key run on tables with one row per slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SLICE, POS, BLOCK, OWN = "_slice", "_pos", "_block", "_own"
#: Rows of a block, halo aside; a reach of more than a quarter of it gets longer blocks.
BLOCK_ROWS = 8192


def names(c) -> list[str]:
    return [] if c is None else [c] if isinstance(c, str) else list(c)


def joined(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``small``; a null key matches a null key."""
    right = small.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in small.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return rows.join(right, cond, "left").drop(*[f"_on_{c}" for c in on])


def sliced(df: DataFrame, key, order, slices: int | None = None) -> DataFrame:
    """``df`` cut into range slices of (key, order), written once with the slice
    number as data, so that every reader sees the same cut."""
    by = [*names(key), *names(order)]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()))


# What each kind of scan does with rows, and with the results of slices.
_SCANS: dict[str, Callable] = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min,
                               "last": lambda c: F.last(c, ignorenulls=True)}


def _plus(a: Column, b: Column) -> Column:
    zero = F.lit(0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) + F.coalesce(b, zero))


_COMBINE = {"sum": _plus, "count": _plus, "max": F.greatest, "min": F.least, "last": lambda a, b: F.coalesce(b, a)}


def segmented_scan(df: DataFrame, scans: dict[str, tuple], key, order, slice_col: str = SLICE,
                   written: bool = False) -> DataFrame:
    """Running aggregates per key over rows that are cut into slices.

    ``scans``: out -> (kind, value) or (kind, value, True); kind is one of sum,
    count, max, min and last (the last value that is not null), and True leaves
    the row itself out.  Slices must be successive in ``order`` by their number.
    ``df`` is read twice, so it is written first unless it is ``written`` already.
    """
    keys, by = names(key), names(order)
    scans = {out: (kind, F.col(v) if isinstance(v, str) else v, any(rest)) for out, (kind, v, *rest) in scans.items()}
    rows = (df if written else materialize(df)).withColumns({f"_v_{out}": v for out, (_, v, _) in scans.items()})
    part = Window.partitionBy(*keys, slice_col).orderBy(*by)
    end = lambda without: part.rowsBetween(Window.unboundedPreceding, -1 if without else Window.currentRow)
    whole = {"last": lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(*by, F.col(c).alias("_x"))))["_x"]}
    ends = rows.groupBy(*keys, slice_col).agg(*[
        whole.get(kind, lambda c, kind=kind: _SCANS[kind](F.col(c)))(f"_v_{out}").alias(f"_s_{out}")
        for out, (kind, *_) in scans.items()])
    # One row per slice and key.
    earlier = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, slice_col, *[
        (F.sum if kind == "count" else _SCANS[kind])(F.col(f"_s_{out}")).over(earlier).alias(f"_c_{out}")
        for out, (kind, *_) in scans.items()])
    scanned = rows.withColumns({f"_l_{out}": _SCANS[kind](F.col(f"_v_{out}")).over(end(without))
                                for out, (kind, _, without) in scans.items()})
    both = joined(scanned, carry, [*keys, slice_col])
    done = both.withColumns({out: _COMBINE[kind](F.col(f"_c_{out}"), F.col(f"_l_{out}")) for out, (kind, *_) in scans.items()})
    return done.drop(*[f"_{x}_{out}" for out in scans for x in "vlc"])


def numbered(df: DataFrame, key, order, slices: int | None = None, scans: dict[str, tuple] | None = None) -> DataFrame:
    """``df`` in slices, each row with its position (from 0) within its key, and
    with the results of further ``scans``."""
    own = {POS: ("count", F.lit(1), True)} | (scans or {})
    return (segmented_scan(sliced(df, key, order, slices), own, key, order, written=True)
            .withColumn(POS, F.coalesce(POS, F.lit(0))))


def previous(df: DataFrame, columns: dict[str, str], key, order) -> DataFrame:
    """The row before, also across slices: out -> column."""
    held = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    rows = segmented_scan(df, {"_prev": ("last", held, True)}, key, order)
    return rows.withColumns({out: F.col("_prev")[out] for out in columns}).drop("_prev")


def with_halo(df: DataFrame, before: int, after: int = 0, block_rows: int | None = None) -> DataFrame:
    """Rows of a :func:`numbered` table in blocks (``_block``) of successive
    positions, with copies of the ``before`` rows ahead of each block and of the
    ``after`` rows behind it; ``_own`` is false for a copy."""
    size = block_rows or max(BLOCK_ROWS, 4 * max(before, after))
    if max(before, after) > size:
        raise ValueError("a block must be at least as long as its halo")
    block = F.floor(F.col(POS) / F.lit(size))
    at = F.col(POS) - block * F.lit(size)
    homes = F.array_compact(F.array(block, F.when(at >= size - before, block + 1), F.when(at < after, block - 1)))
    return (df.withColumns({"_home": block, BLOCK: F.explode(homes)})
            .withColumn(OWN, F.col("_home") == F.col(BLOCK)).drop("_home"))


def windowed(df: DataFrame, compute: Callable[[DataFrame, list[str]], DataFrame], key, before: int, after: int = 0,
             block_rows: int | None = None) -> DataFrame:
    """``compute(rows, key)`` of a :func:`numbered` table, block by block.

    ``compute`` may use any window by ``key`` (the given one and the block) that
    reaches ``before`` rows back and ``after`` rows ahead; it must keep the
    columns it doesn't know.
    """
    out = compute(with_halo(df, before, after, block_rows), [*names(key), BLOCK])
    return out.where(OWN).drop(BLOCK, OWN)


def sliding_extreme(df: DataFrame, outs: dict[str, tuple[str, str]], k: int, key, min_periods: int = 1) -> DataFrame:
    """Extremes over the last ``k`` rows: out -> ("max" or "min", column).

    Within pieces of k positions a running extreme goes forwards and another one
    backwards; a window of k rows is the end of one piece and the start of the
    next.  Null until ``min_periods`` values are there.  ``df`` has positions, and
    its rows may be blocks with a halo of k - 1 rows if ``key`` holds the block.
    """
    keys = names(key)
    piece = f"_piece_{k}"
    rows = df.withColumn(piece, F.floor(F.col(POS) / F.lit(k)))
    ahead = Window.partitionBy(*keys, piece).orderBy(F.col(POS))
    back = Window.partitionBy(*keys, piece).orderBy(F.col(POS).desc())
    w = Window.partitionBy(*keys).orderBy(POS)
    until = (Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"_b_{out}": _SCANS[kind](F.col(c)).over(back.rowsBetween(*until)) for out, (kind, c) in outs.items()})
    rows = rows.withColumns({f"_a_{out}": _SCANS[kind](F.col(c)).over(ahead.rowsBetween(*until)) for out, (kind, c) in outs.items()})
    counts = {c: f"_n_{c}" for _, c in outs.values()} if min_periods > 1 else {}
    rows = rows.withColumns({n: F.count(F.col(c)).over(w.rowsBetween(*until)) for c, n in counts.items()})
    done = {}
    for out, (kind, c) in outs.items():
        value = _COMBINE[kind](F.col(f"_a_{out}"), F.lag(f"_b_{out}", k - 1).over(w))
        if counts:
            held = F.col(counts[c]) - F.coalesce(F.lag(counts[c], k).over(w), F.lit(0))
            value = F.when(held >= min_periods, value)
        done[out] = value
    return rows.withColumns(done).drop(piece, *counts.values(), *[f"_{x}_{out}" for out in outs for x in "ab"])


def ewm_scan(df: DataFrame, values: dict[str, str], alpha: float, key, adjust: bool = True, min_periods: int = 0,
             start: Column | None = None) -> DataFrame:
    """``value.ewm(alpha=...).mean()`` of a :func:`numbered` table: out -> value.

    Blocks are so long (300 / alpha rows) that the weights of one fall by e^-300:
    within a block the weighted sums run locally, and the end of the block before
    is all that is carried in.  With ``adjust`` nulls weigh nothing.  Without it
    the mean starts with the row where ``start`` holds (position 0), is null
    before, and a null behind it is an error (fill it before).
    """
    keys, r = names(key), 1.0 - alpha
    size = max(1, int(300.0 / -math.log(r))) if r > 0 else 1
    rows = materialize(df).withColumn("_blk", F.floor(F.col(POS) / F.lit(size)))
    rows = rows.withColumn("_loc", F.col(POS) - F.col("_blk") * F.lit(size))
    at, parts = F.col("_loc"), {}
    for out, value in values.items():
        x, seen = F.col(value), F.col(value).isNotNull()
        if adjust:
            parts[f"_num_{out}"] = F.coalesce(x, F.lit(0.0))
            parts[f"_den_{out}"] = F.when(seen, 1.0).otherwise(0.0)
        else:
            first = F.coalesce(start, F.lit(False)) if start is not None else F.col(POS) == 0
            parts[f"_num_{out}"] = F.when(first, x).when(seen, x * F.lit(alpha)).otherwise(F.lit(0.0))
            parts[f"_den_{out}"] = F.when(first, 1).otherwise(0).cast("double")  # has it started?
    decays = lambda n: adjust or n.startswith("_num_")
    power = lambda n, e: F.pow(F.lit(r), e) if decays(n) else F.lit(1.0)
    ends = rows.groupBy(*keys, "_blk").agg(*[F.sum(v * power(n, F.lit(size - 1) - at)).alias(n) for n, v in parts.items()])
    if not adjust:  # whether the mean has started: carried over all blocks, one row each
        since = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = ends.withColumns({n: F.sum(n).over(since) for n in parts if not decays(n)})
    ends = ends.withColumn("_blk", F.col("_blk") + 1)
    w = Window.partitionBy(*keys, "_blk").orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"_l{n}": power(n, at) * F.sum(v * power(n, -at)).over(w) for n, v in parts.items()}
    both = joined(rows.withColumns(local), ends, [*keys, "_blk"])
    total = {n: F.col(f"_l{n}") + power(n, at + 1) * F.coalesce(F.col(n), F.lit(0.0)) for n in parts}
    done = {}
    for out, value in values.items():
        num, den = total[f"_num_{out}"], total[f"_den_{out}"]
        if adjust:
            done[out] = F.try_divide(num, den)
        else:
            late = F.raise_error(F.lit(f"null in {value}: fill it before ewm_scan(adjust=False)")).cast("double")
            done[out] = F.when(den > 0, F.when(F.col(value).isNull(), late).otherwise(num))
    done = both.withColumns(done).drop("_blk", "_loc", *parts, *local)
    if min_periods > 1:
        held = {f"_held_{out}": ("count", value) for out, value in values.items()}
        done = segmented_scan(done, held, key, POS)
        done = done.withColumns({out: F.when(F.col(f"_held_{out}") >= min_periods, F.col(out)) for out in values}).drop(*held)
    return done
