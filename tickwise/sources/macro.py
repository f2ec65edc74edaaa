"""Macro series in long form ``(series_id, date, value)``.

The model reads a daily volatility index, a daily 10-year yield quote and a
monthly consumer price index.  With the landed tables those roles are
played by series that Spark derives from them (one grouped aggregate each,
partial+final, so the shuffle carries one row per date per map task):

* ``VIX``  -- average order total per order date / 10,000;
* ``TNX``  -- average line discount per ship date x 1,000 (a yield quote
  in tenths of a percent, scaled by ``/10`` downstream like the index);
* ``CPI``  -- average order total per order month / 1,000, dated on the
  first day of the month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..session import materialize
from .tables import read_table


def macro_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(daily, monthly) of :func:`macro_daily` and :func:`macro_monthly` from one
    scan of orders, grouped by day and by month at once, and one of line items;
    the three series are written once."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day"), finite("o_totalprice").alias("v"))
    orders = orders.withColumn("month", F.trunc("day", "month"))
    both = orders.groupingSets([["day"], ["month"]], "day", "month").agg(
        F.avg("v").alias("mean"), F.grouping("day").alias("monthly"))
    of_orders = both.select(
        F.when(F.col("monthly") == 1, "CPI").otherwise("VIX").alias("series_id"),
        F.when(F.col("monthly") == 1, F.col("month")).otherwise(F.col("day")).alias("date"),
        (F.col("mean") / F.when(F.col("monthly") == 1, F.lit(1000.0)).otherwise(F.lit(10000.0))).alias("value"))
    items = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_discount")
    of_items = (items.groupBy(F.to_date("l_shipdate").alias("date"))
                .agg((F.avg(finite("l_discount")) * F.lit(1000.0)).alias("value"))
                .select(F.lit("TNX").alias("series_id"), "date", "value"))
    series = materialize(of_orders.unionByName(of_items))
    return series.where(F.col("series_id") != "CPI"), series.where(F.col("series_id") == "CPI")


def macro_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily index levels, long form (series_id in VIX, TNX)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    vix = (orders.groupBy(F.to_date("o_orderdate").alias("date"))
           .agg((F.avg(finite("o_totalprice")) / F.lit(10000.0)).alias("value"))
           .select(F.lit("VIX").alias("series_id"), "date", "value"))
    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_discount")
    tnx = (li.groupBy(F.to_date("l_shipdate").alias("date"))
           .agg((F.avg(finite("l_discount")) * F.lit(1000.0)).alias("value"))
           .select(F.lit("TNX").alias("series_id"), "date", "value"))
    return vix.unionByName(tnx)


def macro_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly CPI level, long form (series_id CPI), dated on the 1st."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return (orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date"))
            .agg((F.avg(finite("o_totalprice")) / F.lit(1000.0)).alias("value"))
            .select(F.lit("CPI").alias("series_id"), "date", "value"))
