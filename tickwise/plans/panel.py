"""The full feature panel (J2, P3, P5, P12, S8 + everything upstream), in
the order of the reference:

1. full-history price features W1-W11, forward return and yearly label
   (W12, W13), then forward fill of the bars and the features (W14);
2. left join of the macro calendar on date (J2);
3. quarterly fundamentals as of each bar, bars before the first valid
   quarter cut (J4, P7);
4. on the cut rows: technical indicators W23-W27 and relative strength W28.

Inputs are optional where the reference tolerates a missing source (S8):
no macro -> no macro columns, no statements -> no fundamentals and no cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ffill, panel_window
from ..session import materialize
from ..operators import fundamentals as FU
from ..operators.indicators import technical_indicators
from ..operators.labels import yearly_quantile_label
from ..operators.price import PRICE_FEATURES, price_features
from ..operators.relative import relative_strength
from ..sources.statements import report_dates

TARGETS = ("target_3m_raw", "target_3m")


def feature_panel(bars: DataFrame, macro: DataFrame | None = None,
                  statements: DataFrame | None = None, benchmarks=(),
                  bench_bars: DataFrame | None = None, items: list[str] | None = None,
                  tail: str = "zero", fill_raw_target: bool = False,
                  delay_days: int = FU.DELAY_DAYS, carry_last: bool = False,
                  checkpoint_aligned: bool = True) -> DataFrame:
    """Build the panel.  ``statements`` are parsed statement rows
    (:func:`tickwise.sources.statements.parse_statements`); ``bench_bars``
    defaults to ``bars``.  ``fill_raw_target=True`` also forward-fills the
    raw forward return into the tail, as the reference's whole-frame fill
    does (off by default: it leaks a stale value into the label input).

    ``checkpoint_aligned`` writes the aligned, trimmed panel (steps 1-3) to
    the reliable checkpoint directory before the indicator block: the rest
    of the plan then starts from a file scan instead of the whole lineage,
    which keeps analysis and adaptive re-planning cheap and makes a lost
    executor re-read files instead of recomputing the feature windows."""
    w = panel_window()
    d = price_features(bars)
    d = yearly_quantile_label(d, tail=tail)
    fill = ["open", "high", "low", "close", "volume", *PRICE_FEATURES,
            *(["target_3m_raw"] if fill_raw_target else [])]
    d = d.select(*[ffill(c, w).alias(c) if c in fill else F.col(c) for c in d.columns])
    if macro is not None:
        d = d.join(macro, "date", "left")
    if statements is not None:
        long = FU.fundamentals_long(statements)
        d = FU.asof_fundamentals(d, long, report_dates(statements), items,
                                 delay_days=delay_days, carry_last=carry_last)
        d = d.drop("fiscal_date")
    if checkpoint_aligned:
        d = materialize(d)
    d = technical_indicators(d)
    if benchmarks:
        src = bench_bars if bench_bars is not None else bars
        d = relative_strength(d, list(benchmarks), bench_bars=src)
    return d


def feature_columns(panel: DataFrame, exclude=("symbol", "date") + TARGETS) -> list[str]:
    """P3 + P12: numeric model inputs (targets and keys dropped)."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [f.name for f in panel.schema.fields
            if f.name not in exclude and f.dataType.simpleString() in numeric]
