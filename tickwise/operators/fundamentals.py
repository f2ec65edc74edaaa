"""quarterly
fundamentals from parsed statements (long form
``(symbol, statement, fiscal_date, item, value)``).

Order of the reference, kept here:

1. per statement: ratios of raw items that are both present (F4), drop
   items that are missing in more than 70 % of the statement's quarters
   (P10, ratios included), ``log1p`` of positive values in items whose
   maximum exceeds 1e6 (F1);
2. across statements: an item present in several statements is taken from
   the first statement in precedence order (P11);
3. alignment: the statements' quarters are unioned (J3), every quarter's row
   becomes valid ``delay`` days after its fiscal date until ``delay`` days
   after the next quarter (W22 + F7, row-level forward fill), and bars are
   attached with an interval join (J4); bars before the first valid date
   are cut (P7).

Everything stays in long form until the final pivot, so which columns exist
is data (rows), never driver state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import pct_change, safe_div
from ..sources.statements import STATEMENTS
from .asof import interval_join

# Ratio name -> (numerator item, denominator item); a ratio is
# computed only when both items are present in the same statement.
RATIOS = (
    ("ProfitMargin", "netIncome", "totalRevenue"),
    ("DebtEquity", "totalLiabilities", "totalShareholderEquity"),
    ("CurrentRatio", "totalCurrentAssets", "totalCurrentLiabilities"),
    ("FreeCashFlowMargin", "operatingCashflow", "totalRevenue"),
    ("ROA", "netIncome", "totalAssets"),
)

# Canonical name -> candidate item names, first present wins.
ALIASES = (
    ("total_liab", ("totalLiab", "totalLiabilities")),
    ("equity", ("totalStockholderEquity", "totalShareholderEquity")),
    ("current_assets", ("totalCurrentAssets",)),
    ("current_liabilities", ("totalCurrentLiabilities",)),
)

NULL_THRESHOLD = 0.7
LOG_THRESHOLD = 1e6
DELAY_DAYS = 90


def statement_ratios(long: DataFrame) -> DataFrame:
    """ratio rows ``(symbol, statement, fiscal_date, item, value)`` for
    every quarter of a statement that contains both inputs of a ratio."""
    needed = sorted({x for _, a, b in RATIOS for x in (a, b)})
    it = F.col("item")
    per_date = long.groupBy("symbol", "statement", "fiscal_date").agg(
        *[F.max(F.when(it == x, F.col("value"))).alias(f"v_{x}") for x in needed],
        *[F.max((it == x).cast("int")).alias(f"h_{x}") for x in needed])
    st = Window.partitionBy("symbol", "statement")
    for x in needed:
        per_date = per_date.withColumn(f"h_{x}", F.max(f"h_{x}").over(st))
    cand = F.array(*[
        F.struct(F.lit(name).alias("item"),
                 safe_div(f"v_{a}", f"v_{b}").alias("value"),
                 ((F.col(f"h_{a}") == 1) & (F.col(f"h_{b}") == 1)).alias("ok"))
        for name, a, b in RATIOS])
    rows = per_date.select("symbol", "statement", "fiscal_date", F.explode(cand).alias("r"))
    return rows.where("r.ok").select("symbol", "statement", "fiscal_date",
                                     F.col("r.item").alias("item"), F.col("r.value").alias("value"))


def with_ratios(long: DataFrame) -> DataFrame:
    return long.unionByName(statement_ratios(long))


def _with_null_frac(long: DataFrame) -> DataFrame:
    """Add ``_frac``: share of the statement's quarters in which the row's
    item is missing.  Window counts only (partitioned by symbol and
    statement), no self-join: ``_n`` = number of quarters of the statement,
    ``_nn`` = non-null values of the item."""
    st = Window.partitionBy("symbol", "statement")
    d = long.withColumn("_dr", F.dense_rank().over(st.orderBy("fiscal_date")))
    d = d.withColumn("_n", F.max("_dr").over(st))
    d = d.withColumn("_nn", F.count("value").over(Window.partitionBy("symbol", "statement", "item")))
    return d.withColumn("_frac", (F.col("_n") - F.col("_nn")).cast("double") / F.col("_n"))


def null_ratios(long: DataFrame, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """P10 report: ``(symbol, statement, item, null_frac, kept)``; the share
    of a statement's quarters in which the item is missing, kept when it is
    not above ``threshold``."""
    d = _with_null_frac(long).where(F.col("item").isNotNull())
    return (d.groupBy("symbol", "statement", "item").agg(F.first("_frac").alias("null_frac"))
             .withColumn("kept", F.col("null_frac") <= F.lit(threshold)))


def drop_sparse(long: DataFrame, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """P10: keep only items missing in at most ``threshold`` of the quarters."""
    d = _with_null_frac(long)
    return (d.where(F.col("item").isNotNull() & (F.col("_frac") <= F.lit(threshold)))
             .drop("_dr", "_n", "_nn", "_frac"))


def log_scale(long: DataFrame, threshold: float = LOG_THRESHOLD) -> DataFrame:
    """``log1p(x)`` for positive x in items whose maximum exceeds
    ``threshold`` (per symbol and statement); other values untouched."""
    mx = F.max("value").over(Window.partitionBy("symbol", "statement", "item"))
    v = F.col("value")
    return long.withColumn("value", F.when((mx > F.lit(threshold)) & (v > 0), F.log1p(v))
                           .otherwise(v))


def dedupe_items(long: DataFrame, order: tuple[str, ...] = STATEMENTS) -> DataFrame:
    """An item present in several statements is kept from the first one
    in ``order`` only (decided per item, not per value)."""
    rank = F.when(F.col("statement") == order[0], F.lit(0))
    for i, s in enumerate(order[1:], start=1):
        rank = rank.when(F.col("statement") == s, F.lit(i))
    rank = rank.otherwise(F.lit(len(order)))
    d = long.withColumn("_rk", rank).withColumn(
        "_best", F.min("_rk").over(Window.partitionBy("symbol", "item")))
    return d.where(F.col("_rk") == F.col("_best")).drop("_rk", "_best")


def cross_statement_ratios(long: DataFrame, null_threshold: float = NULL_THRESHOLD) -> DataFrame:
    """Q12 option: ratios whose inputs sit in different statements (ROA =
    net income / total assets, free-cash-flow margin), computed on the
    merged raw values of each quarter (statement ``"merged"``); ratios a
    single statement already produced are not repeated."""
    merged = dedupe_items(long).withColumn("statement", F.lit("merged"))
    x = statement_ratios(merged)
    have = long.where(F.col("item").isNotNull()).select("symbol", "item").distinct()
    x = x.join(have, ["symbol", "item"], "left_anti")
    return drop_sparse(x, null_threshold)


def fundamentals_long(parsed: DataFrame, null_threshold: float = NULL_THRESHOLD,
                      log_threshold: float = LOG_THRESHOLD,
                      cross_statement: bool = False) -> DataFrame:
    """Steps 1-2 of the module docstring: the final item values per quarter.
    ``cross_statement=True`` adds :func:`cross_statement_ratios` (the
    reference computes a ratio only when one statement holds both inputs)."""
    items = parsed.where(F.col("item").isNotNull())
    d = with_ratios(items)
    d = drop_sparse(d.unionByName(parsed.where(F.col("item").isNull())), null_threshold)
    if cross_statement:
        d = d.unionByName(cross_statement_ratios(d, null_threshold))
    d = log_scale(d, log_threshold)
    return dedupe_items(d, STATEMENTS + ("merged",))


def item_names(long: DataFrame) -> list[str]:
    """Distinct item names (a schema-sized list, for an explicit pivot)."""
    return sorted(r[0] for r in long.select("item").distinct().collect() if r[0] is not None)


def quarterly_wide(long: DataFrame, dates: DataFrame, items: list[str]) -> DataFrame:
    """One row per (symbol, fiscal_date) over the union of all statements'
    quarters, one column per item (NULL where that quarter lacks it)."""
    wide = (long.where(F.col("item").isin(items))
            .groupBy("symbol", "fiscal_date").pivot("item", items).agg(F.first("value")))
    return dates.join(wide, ["symbol", "fiscal_date"], "left")


def validity(dates: DataFrame, delay_days: int = DELAY_DAYS) -> DataFrame:
    """W22 + F7: ``[fiscal + delay, next fiscal + delay)``; the last quarter is
    valid for one day (the daily resample ends at the last fiscal date)."""
    w = Window.partitionBy("symbol").orderBy("fiscal_date")
    nxt = F.lead("fiscal_date", 1).over(w)
    return dates.select(
        "symbol", "fiscal_date",
        F.date_add("fiscal_date", delay_days).alias("eff_from"),
        F.coalesce(F.date_add(nxt, delay_days),
                   F.date_add("fiscal_date", delay_days + 1)).alias("eff_to"))


def asof_fundamentals(bars: DataFrame, long: DataFrame, dates: DataFrame,
                      items: list[str] | None = None, delay_days: int = DELAY_DAYS,
                      carry_last: bool = False, trim: bool = True) -> DataFrame:
    """J4 (+ P7): attach to every bar the quarter valid on its date.

    ``carry_last=True`` keeps the last quarter valid after its own period
    (the reference stops there: later bars get NULLs).  ``trim`` cuts each
    symbol's bars before its first valid date; symbols without statements
    are kept whole (S8).
    """
    items = items if items is not None else item_names(long)
    iv = validity(dates, delay_days)
    if carry_last:
        last_bar = bars.groupBy("symbol").agg(F.date_add(F.max("date"), 1).alias("_end"))
        w = Window.partitionBy("symbol").orderBy(F.col("fiscal_date").desc())
        iv = (iv.join(last_bar, "symbol", "left")
                .withColumn("eff_to", F.when(F.row_number().over(w) == 1,
                                             F.greatest("eff_to", F.coalesce("_end", "eff_to")))
                            .otherwise(F.col("eff_to"))).drop("_end"))
    wide = quarterly_wide(long, dates, items)
    ivw = iv.join(wide, ["symbol", "fiscal_date"], "left")
    out = interval_join(bars, ivw, "symbol", "date", "eff_from", "eff_to", how="left")
    out = out.drop("eff_from", "eff_to")
    if trim:
        first = iv.groupBy("symbol").agg(F.min("eff_from").alias("_first"))
        out = (out.join(first, "symbol", "left")
                  .where(F.col("_first").isNull() | (F.col("date") >= F.col("_first")))
                  .drop("_first"))
    return out


def first_available(spark: SparkSession, long: DataFrame,
                    aliases=ALIASES) -> DataFrame:
    """For each canonical name, the values of the first candidate item
    present in the statement (presence, not non-nullness, decides).
    ``(symbol, statement, fiscal_date, canonical, source_item, value)``."""
    rows = [(canon, cand, i) for canon, cands in aliases for i, cand in enumerate(cands)]
    schema = T.StructType([T.StructField("canonical", T.StringType()),
                           T.StructField("item", T.StringType()),
                           T.StructField("_prio", T.IntegerType())])
    table = spark.createDataFrame(rows, schema)  # fixed, a handful of rows
    d = long.join(F.broadcast(table), "item").withColumn(
        "_best", F.min("_prio").over(Window.partitionBy("symbol", "statement", "canonical")))
    return (d.where(F.col("_prio") == F.col("_best"))
             .select("symbol", "statement", "fiscal_date", "canonical",
                     F.col("item").alias("source_item"), "value"))


def quarterly_growth(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """W30 (+ J8): growth ratios over each statement's own quarters, raw
    values: revenue and profit-margin YoY (4 quarters) from the income
    statement; debt/equity QoQ and YoY and current-ratio QoQ from the
    balance sheet (inputs through :func:`first_available`)."""
    w = Window.partitionBy("symbol").orderBy("fiscal_date")
    inc = (parsed.where(F.col("statement") == "income")
           .groupBy("symbol", "fiscal_date")
           .agg(F.max(F.when(F.col("item") == "totalRevenue", F.col("value"))).alias("rev"),
                F.max(F.when(F.col("item") == "netIncome", F.col("value"))).alias("ni")))
    inc = inc.select("symbol", "fiscal_date",
                     safe_div("ni", "rev").alias("profit_margin"),
                     pct_change("rev", 4, w).alias("revenue_yoy"))
    inc = inc.withColumn("profit_margin_yoy", pct_change("profit_margin", 4, w))
    bal_dates = parsed.where(F.col("statement") == "balance").select(
        "symbol", "fiscal_date").distinct()
    fa = first_available(spark, parsed.where(F.col("statement") == "balance"))
    piv = fa.groupBy("symbol", "fiscal_date").agg(*[
        F.max(F.when(F.col("canonical") == c, F.col("value"))).alias(c) for c, _ in ALIASES])
    bal = bal_dates.join(piv, ["symbol", "fiscal_date"], "left").select(
        "symbol", "fiscal_date",
        safe_div("total_liab", "equity").alias("debt_equity"),
        safe_div("current_assets", "current_liabilities").alias("current_ratio"))
    bal = bal.select("symbol", "fiscal_date", "debt_equity", "current_ratio",
                     pct_change("debt_equity", 1, w).alias("debt_equity_qoq"),
                     pct_change("debt_equity", 4, w).alias("debt_equity_yoy"),
                     pct_change("current_ratio", 1, w).alias("current_ratio_qoq"))
    return inc.join(bal, ["symbol", "fiscal_date"], "full_outer")
