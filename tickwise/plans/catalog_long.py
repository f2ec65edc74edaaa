"""Registered queries on series and groups of any length: minute bars of one
symbol, quantiles of large groups, as-of joins by time.  Registered like those
of :mod:`tickwise.plans.catalog`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_cols
from ..functions.selection import exact_percentile
from ..operators import long_series as LS
from ..operators import macro as M
from ..operators import price as P
from ..operators import train as T
from ..operators.asof import asof_join
from ..session import ensure_checkpoint_dir, materialize
from ..sources import bars as B
from ..sources import landed as LD
from ..sources import macro as SM
from ..sources import statements as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["symbol", "date"]
#: Rows of the sliding extremes, far beyond what a frame should be scanned for.
EXTREME_ROWS, STOCHASTIC_ROWS = 1500, 700


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def bars_minute(spark, sf_dir):
    """Minute bars of all events as one symbol."""
    return round_cols(B.bars_minute(spark, sf_dir))


@query
def minute_price_features(spark, sf_dir):
    """W1-W11 on one very long symbol, by halo windows."""
    feats = LS.long_price_features(B.bars_minute(spark, sf_dir))
    return round_cols(feats.select(*KEYS, *P.PRICE_FEATURES))


@query
def minute_extremes(spark, sf_dir):
    """W6 and W26 over long windows, by block extremes."""
    bars = B.bars_minute(spark, sf_dir)
    out = LS.long_stochastic(LS.long_max_drawdown(bars, EXTREME_ROWS), STOCHASTIC_ROWS)
    return round_cols(out.select(*KEYS, "max_drawdown", "stochastic_k", "stochastic_d"))


@query
def minute_scans(spark, sf_dir):
    """W14, W23, W24 and W27 on one very long symbol whose close is missing in
    every seventh minute of an hour, by carries between slices."""
    bars = B.bars_minute(spark, sf_dir)
    bars = bars.withColumn("close", F.when(F.minute("date") % 7 != 0, F.col("close")))
    return round_cols(LS.long_scans(bars).select(*KEYS, *LS.SCANNED))


@query
def yearly_label_selected(spark, sf_dir):
    """The growth label with quantiles by distributed selection."""
    out = LS.long_quantile_label(B.bars_daily(spark, sf_dir))
    return round_cols(out.select("symbol", "date", F.year("date").alias("year"), "threshold", "target_3m"))


@query
def trade_price_quantile(spark, sf_dir):
    """A1 on groups that grow with the trades: quantiles of the price of all
    trades of a symbol and year."""
    trades = B.trades(spark, sf_dir).select("symbol", F.year("l_shipdate").alias("year"), "px")
    out = None
    for name, q in (("q10", 0.1), ("median", 0.5), ("q60", 0.6)):
        found = exact_percentile(trades, ["symbol", "year"], "px", q, name)
        out = found if out is None else out.join(found, ["symbol", "year"])
    return round_cols(out)


@query
def asof_reports(spark, sf_dir):
    """J4 at the grain of timestamps: hourly bars with the last report that was
    published at least 90 minutes before the hour."""
    bars = B.bars_hourly(spark, sf_dir).select(*KEYS, "close")
    reports = B.event_reports(spark, sf_dir).withColumn("known_at", F.col("published_at") + F.expr("INTERVAL 90 MINUTES"))
    out = asof_join(bars, reports, "symbol", "date", "known_at").drop("known_at")
    return round_cols(out.withColumn("n_events", F.col("n_events").cast("double")))


def _landed_series(spark, sf_dir):
    """The VIX role as CSV lines in the shared folder; every tenth day of a month
    lands as a line that is no number, every seventh without a value."""
    day = F.dayofmonth("date")
    text = F.when(day % 10 == 0, "n/a").when(day % 7 == 0, "").otherwise(F.col("value").cast("string"))
    lines = SM.macro_daily(spark, sf_dir).where("series_id = 'VIX'").select(
        F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), text).alias("value"))
    path = f"{ensure_checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
    lines.write.text(path)
    return path


@query
def landed_series(spark, sf_dir):
    """A landed daily series between two dates, malformed lines left out."""
    path = _landed_series(spark, sf_dir)
    return round_cols(LD.read_series(spark, path, "VIX", start="1993-01-01", end="1996-12-31", header=False))


@query
def landed_audit(spark, sf_dir):
    """What the reader left out."""
    return LD.audit(LD.series_lines(spark, _landed_series(spark, sf_dir), header=False))


@query
def features_incremental(spark, sf_dir):
    """Price features in a bucketed table with a partition per year, written
    for all years and once more for the last one, with negated closes; read back."""
    feats = materialize(P.price_features(B.bars_daily(spark, sf_dir)).withColumn("day", F.trunc("date", "year")))
    name = f"features_{uuid.uuid4().hex}"
    T.upsert_features(feats, name, f"{ensure_checkpoint_dir(spark)}/{name}")
    newest = feats.join(feats.agg(F.max("day").alias("day")), "day")
    T.upsert_features(newest.withColumn("close", -F.col("close")), name, "")
    return round_cols(spark.table(name).select(*KEYS, "close", *P.PRICE_FEATURES))


@query
def statement_audit(spark, sf_dir):
    """What the statement reader can't use: beside the readable documents, one
    of each cut in half, one missing, one without reports and one without a date."""
    docs = ST.statements_from_orders(spark, sf_dir)
    faults = {"cut": F.expr("substring(body, 1, length(body) div 2)"), "missing": F.lit(None).cast("string"),
              "empty": F.lit('{"quarterlyReports": []}'),
              "undated": F.lit('{"quarterlyReports": [{"fiscalDateEnding": "soon", "netIncome": "1"}]}')}
    landed = docs
    for name, body in faults.items():
        landed = landed.unionByName(docs.select(F.concat_ws("/", "symbol", F.lit(name)).alias("symbol"), "statement",
                                                body.alias("body")))
    return ST.unreadable_statements(landed)


@query
def macro_without_yields(spark, sf_dir):
    """The macro calendar of a daily table that lacks the yields and a missing
    monthly one."""
    daily = SM.macro_daily(spark, sf_dir).where("series_id = 'VIX'")
    return round_cols(M.build_macro(daily, None))
