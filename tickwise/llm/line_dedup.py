"""Line dedup by site-relative frequency, in DataFrame operations only.

A line is boilerplate of a host if more than ``ratio`` of the host's pages
hold it.  A page counts once for a line, however often it repeats it.  Pages
are counted by (host, line hash) with map-side aggregation, so a hot host
costs no more than others, and line texts are never shuffled.

The boilerplate of one host is bounded whatever its size: its pages hold L
distinct lines on average, so at most L / ratio lines can exceed the ratio.
That set is joined back to the documents as one array per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

RATIO = 0.1
#: A line on one page repeats nothing, whatever the share of that page.
MIN_HELD = 2
#: Boilerplate lines and hosts that are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 2_000_000
BLANK = " \t\r"


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n")


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(BLANK)))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_held: int = MIN_HELD) -> DataFrame:
    """(host, pages, lines): the hashes of the boilerplate lines of each host.

    Lines are compared without the blanks around them; blank lines don't
    count.  Pages with a null host belong to none.
    """
    own = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), _lines(text).alias("line"))
    pages = own.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    filled = F.filter("line", lambda x: F.trim(x, F.lit(BLANK)) != "")
    held = (own.select("host", F.explode(F.array_distinct(F.transform(filled, _key))).alias("key"))
            .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_held))
    return (held.join(pages, "host")
            .where(F.col("n") / F.col("pages") > ratio)
            .groupBy("host", "pages").agg(F.collect_list("key").alias("lines")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_held: int = MIN_HELD, out: str = "deduped") -> DataFrame:
    """``docs`` plus a struct ``out``: ``n_lines``, ``n_dropped`` and the ``text``
    without the boilerplate lines of its host, its other lines as they were.

    A null text has no lines and stays null; an empty one is one blank line.
    The ratio judges hosts of every size alike; a line must stand on ``min_held``
    pages (two: it repeats).  Pages without a host lose nothing.  Lines are equal
    by a 64-bit hash.  Other columns pass through, whatever their names; one named
    ``out`` is replaced.
    """
    sets = materialize(boilerplate(docs, host, text, ratio, min_held)
                       .select(F.col("host").alias("__host"), F.col("lines").alias("__lines")))
    size = sets.agg(F.sum(F.size("__lines")) + F.count(F.lit(1))).first()[0] or 0
    if size <= BROADCAST_LINES:
        sets = F.broadcast(sets)
    rest = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(host).alias("__on"), F.col(text).alias("__text"))
    joined = rows.join(sets, F.col("__on") == F.col("__host"), "left")
    cut = joined.select("row", _lines("__text").alias("__all"), "__lines")
    kept = cut.select("row", "__all", F.when(F.col("__lines").isNull(), F.col("__all")).otherwise(
        F.filter("__all", lambda x: ~F.array_contains("__lines", _key(x)))).alias("__kept"))
    count = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    return kept.select(*[F.col(f"row.`{c}`") for c in rest], F.struct(
        count("__all").alias("n_lines"), (count("__all") - count("__kept")).alias("n_dropped"),
        F.array_join("__kept", "\n").alias("text")).alias(out))
