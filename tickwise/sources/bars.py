"""Daily (or hourly) OHLCV bars.

The price source of the model is a bar table
``(symbol string, date date, open, high, low, close, volume double)``.
Here the bars are built from trade-level rows with one grouped aggregate:
open and close are the prices of the first and last trade by an explicit
total order (``min_by`` / ``max_by`` over a struct), so the result does not
depend on partitioning or input order.  The aggregate is partial+final:
each map task combines its trades per (symbol, date) before the shuffle, so
the exchange carries at most ``symbols x dates`` rows per task however many
trades a symbol has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from ..functions.joins import broadcast_if_small
from ..session import materialize
from .tables import read_table

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])


def read_bars(spark: SparkSession, path: str, symbols: list[str] | None = None,
              start: str | None = None, end: str | None = None) -> DataFrame:
    """Landed OHLCV bars (Parquet, :data:`BAR_SCHEMA`).  The symbols and the
    dates (both inclusive) are pushed into the scan; NaN and infinite values
    are read as NULL, and rows without a symbol or date are dropped."""
    bars = spark.read.schema(BAR_SCHEMA).parquet(path)
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.where(F.col("date") <= F.lit(end).cast("date"))
    bars = bars.where(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    return bars.select("symbol", "date", *[finite(c).alias(c) for c in BAR_SCHEMA.names[2:]])


def build_bars(trades: DataFrame, symbol: Column, ts: Column, price: Column,
               qty: Column, order_by: list[Column], written: bool = False) -> DataFrame:
    """Aggregate trades into OHLCV bars.  Trades without a finite price are
    left out, quantities that are not finite count as missing.

    ``ts`` is the bar key (already truncated to the grain), ``order_by`` the
    total order of trades inside a bar (ties must be broken by the caller).

    A struct makes Spark sort all trades of a task.  With ``written`` they are
    hashed instead: the first scan writes each bar's least and greatest value of
    ``order_by[0]``, and only trades of these two (or of none) are ordered in a
    second scan.  The bars are the same.
    """
    t = trades.select(symbol.alias("symbol"), ts.alias("date"), price.alias("px"),
                      qty.alias("qty"), F.struct(*[c.alias(f"col{i}") for i, c in enumerate(order_by, 1)]).alias("ord"))
    t = t.withColumns({"px": finite("px"), "qty": finite("qty")}).where(F.col("px").isNotNull())
    ends = [F.min_by("px", "ord").alias("open"), F.max_by("px", "ord").alias("close")]
    rest = [F.max("px").alias("high"), F.min("px").alias("low"), F.sum("qty").cast("double").alias("volume")]
    if not written:
        return t.groupBy("symbol", "date").agg(*ends, *rest).select("symbol", "date", *BAR_SCHEMA.names[2:])
    t = t.withColumn("lead", F.col("ord").getField("col1"))
    wide = materialize(t.groupBy("symbol", "date").agg(F.min("lead").alias("least"), F.max("lead").alias("most"), *rest))
    # A NULL symbol or date is a bar of its own, and a NULL comes first in the order.
    own = wide.select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date"), "least", "most")
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("date").eqNullSafe(F.col("_date"))
    edge = (t.join(own, same).where(F.col("lead").isNull() | F.col("lead").isin(F.col("least"), F.col("most")))
            .groupBy("_symbol", "_date").agg(*ends))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("date").eqNullSafe(F.col("_date"))
    return materialize(wide.join(edge, same).select("symbol", "date", *BAR_SCHEMA.names[2:]))


def supplier_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s_suppkey -> symbol`` (the supplier's region name).

    nation (25 rows) and region (5 rows) have a fixed size, so they are
    broadcast explicitly.  The supplier mapping grows with the data: it is
    broadcast to the line-item scan only when a count shows it is small
    (:func:`broadcast_if_small`); beyond that the join shuffles on the key.
    """
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nr = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return (supplier.join(F.broadcast(nr), supplier.s_nationkey == nr.n_nationkey)
            .select("s_suppkey", F.col("r_name").alias("symbol")))


def trades(spark: SparkSession, sf_dir: str, symbols: list[str] | None = None,
           start: str | None = None, end: str | None = None) -> DataFrame:
    """Line items as trades: the columns read, ``symbol`` (supplier region) and
    the price ``px`` (extended price / quantity).  ``start``/``end`` (inclusive)
    are pushed into the Parquet scan."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(end).cast("date"), 1)
                      .cast("timestamp_ntz"))
    sup = supplier_symbols(spark, sf_dir)
    if symbols is not None:
        sup = sup.where(F.col("symbol").isin(list(symbols)))
    sup = broadcast_if_small(sup, read_table(spark, sf_dir, "supplier"))
    joined = li.join(sup, li.l_suppkey == sup.s_suppkey)
    return joined.withColumn("px", F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))


def bars_daily(spark: SparkSession, sf_dir: str, symbols: list[str] | None = None,
               start: str | None = None, end: str | None = None, written: bool = False) -> DataFrame:
    """Daily bars from line items: symbol = supplier region, date = ship date,
    price = extended price / quantity, volume = quantity.

    ``(l_orderkey, l_linenumber)`` is not unique in the landed data, so the
    open/close order is ``(l_orderkey, l_linenumber, l_partkey, px)``.
    ``start``/``end`` (inclusive) are pushed into the Parquet scan, ``written``
    is that of :func:`build_bars`.
    """
    return build_bars(
        trades(spark, sf_dir, symbols, start, end),
        symbol=F.col("symbol"),
        ts=F.to_date(F.col("l_shipdate")),
        price=F.col("px"),
        qty=F.col("l_quantity"),
        order_by=[F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("px")],
        written=written,
    )


def _hour_of(ts: Column) -> Column:
    """Hour bucket of a time-zone-free timestamp, kept time-zone free
    (``date_trunc`` would go through the session time zone)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars from the event stream table: symbol = event type,
    price = value, volume = number of events, true intra-bar order by
    ``(ts, event_id)``.  ``date`` holds the hour (timestamp)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return build_bars(
        ev,
        symbol=F.col("event_type"),
        ts=_hour_of(F.col("ts")),
        price=F.col("value"),
        qty=F.lit(1.0),
        order_by=[F.col("ts"), F.col("event_id")],
    )


def bars_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars of all events as one symbol, ``ALL``: one very long series."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    ts = F.col("ts")
    return build_bars(
        ev,
        symbol=F.lit("ALL"),
        ts=F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0)),
        price=F.col("value"),
        qty=F.lit(1.0),
        order_by=[ts, F.col("event_id")],
    )


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports at the grain of timestamps: per event type and quarter of a day,
    published with its last event ``(symbol, published_at, n_events, mean_value)``."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", finite("value").alias("value"))
    return (ev.where("value is not null and ts is not null")
            .groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("day"), F.expr("hour(ts) div 6").alias("part"))
            .agg(F.max("ts").alias("published_at"), F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("mean_value"))
            .drop("day", "part"))
