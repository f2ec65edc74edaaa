"""Relative strength against benchmark series.

The benchmark closes are aligned to each symbol's own trading days
(``reindex``: exact-date match), forward filled along those days, and
turned into returns without further filling; ``rs_<bench>`` is the
symbol's padded daily return minus the benchmark's.

All benchmarks are pivoted into one row per date first, so there is a
single equi-join on ``date`` whatever the number of benchmarks; that table
has one row per calendar day, and the planner broadcasts it only when its
measured size allows.  Benchmarks that are rows of the same bar table are read
off a window over each date instead, so the table is scanned once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ffill, panel_window, pct_change


def rs_name(bench: str) -> str:
    return "rs_" + re.sub(r"[^0-9a-z]+", "_", bench.lower()).strip("_")


def benchmark_closes(bench_bars: DataFrame, benchmarks: list[str], key="symbol",
                     order="date") -> DataFrame:
    """One row per date, one ``_b{i}`` close column per benchmark."""
    wide = (bench_bars.where(F.col(key).isin(list(benchmarks)))
            .groupBy(order).pivot(key, list(benchmarks)).agg(F.first("close")))
    return wide.select(order, *[F.col(f"`{b}`").alias(f"_b{i}") for i, b in enumerate(benchmarks)])


def align_benchmarks(df: DataFrame, bench_bars: DataFrame | None, benchmarks: list[str],
                     key="symbol", order="date") -> DataFrame:
    """J5 + W14: each benchmark's close on the symbol's dates (``_b<i>``), forward
    filled along the symbol's rows (``_bf<i>``).  ``bench_bars=None``: the
    benchmarks are symbols of ``df`` itself."""
    w = panel_window(key, order)
    if bench_bars is None:
        day = Window.partitionBy(order)  # as many rows as there are symbols
        d = df.withColumns({f"_b{i}": F.max(F.when(F.col(key) == b, F.col("close"))).over(day)
                            for i, b in enumerate(benchmarks)})
    else:
        d = df.join(benchmark_closes(bench_bars, benchmarks, key, order), order, "left")
    for i, _ in enumerate(benchmarks):
        d = d.withColumn(f"_bf{i}", ffill(f"_b{i}", w))
    return d


def relative_strength(df: DataFrame, benchmarks: list[str], bench_bars: DataFrame | None = None,
                      key="symbol", order="date") -> DataFrame:
    """Add ``rs_<bench>`` for every benchmark (not shifted, as in the reference).

    ``bench_bars`` defaults to ``df`` itself (benchmarks are rows of the same
    bar table); pass another bar table for external index series.
    """
    if not benchmarks:
        return df
    w = panel_window(key, order)
    src = None if bench_bars is None else bench_bars.select(key, order, "close")
    d = align_benchmarks(df, src, benchmarks, key, order)
    stock_ret = pct_change("close", 1, w, pad=True)
    for i, b in enumerate(benchmarks):
        d = d.withColumn(rs_name(b), stock_ret - pct_change(f"_bf{i}", 1, w, pad=False))
    drop = [f"_b{i}" for i in range(len(benchmarks))] + [f"_bf{i}" for i in range(len(benchmarks))]
    return d.drop(*drop)
