"""Landed text files: OHLCV bars and macro series as CSV.

Files are read with a fixed schema in PERMISSIVE mode: a line that doesn't fit
keeps its text in ``_corrupt`` beside what could be read, so nothing is lost
silently.  The readers give the clean rows, the audits count the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from .bars import BAR_SCHEMA

CORRUPT = "_corrupt"
SERIES_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("value", T.DoubleType())])


def _lines(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("header", header).option("dateFormat", "yyyy-MM-dd").option("enforceSchema", True).csv(path))


def _within(start: str | None, end: str | None) -> Column:
    inside = F.col("date").isNotNull()
    if start is not None:
        inside = inside & (F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col("date") <= F.lit(end).cast("date"))
    return inside


def series_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Every line of a series file: ``date, value`` and ``_corrupt``."""
    return _lines(spark, path, SERIES_SCHEMA, header)


def read_series(spark: SparkSession, path: str, series_id: str, start: str | None = None, end: str | None = None,
                header: bool = True) -> DataFrame:
    """``(series_id, date, value)`` of a landed daily or monthly series,
    between two dates (inclusive).  Lines that don't fit the schema, or without a
    date, are left out; a missing, NaN or infinite value is NULL."""
    lines = series_lines(spark, path, header)
    return (lines.where(F.col(CORRUPT).isNull() & _within(start, end))
            .select(F.lit(series_id).alias("series_id"), "date", finite("value").alias("value")))


def read_bars_csv(spark: SparkSession, path: str, symbols: list[str] | None = None, start: str | None = None,
                  end: str | None = None, header: bool = True) -> DataFrame:
    """Bars as :func:`..bars.read_bars` gives them, from CSV files."""
    lines = _lines(spark, path, BAR_SCHEMA, header).where(F.col(CORRUPT).isNull() & _within(start, end))
    if symbols is not None:
        lines = lines.where(F.col("symbol").isin(list(symbols)))
    return (lines.where(F.col("symbol").isNotNull())
            .select("symbol", "date", *[finite(c).alias(c) for c in BAR_SCHEMA.names[2:]]))


def audit(lines: DataFrame) -> DataFrame:
    """One row: lines, corrupt lines, lines without a date, lines without a finite
    value, and the first and last date of the rest."""
    good = F.col(CORRUPT).isNull()
    number = lambda c: F.count(F.when(c, 1))
    value = finite("value")
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), number(~good).alias("n_corrupt"),
                     number(good & F.col("date").isNull()).alias("n_undated"),
                     number(good & F.col("date").isNotNull() & value.isNull()).alias("n_missing"),
                     F.min(F.when(good, F.col("date"))).alias("first_date"), F.max(F.when(good, F.col("date"))).alias("last_date"))
