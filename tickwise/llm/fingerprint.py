"""Document fingerprints by a threshold-scaled sketch, in DataFrame operations.

A sketch keeps every hash of a text's word shingles below a fixed fraction of
the hash range.  Its size follows the text, so texts of very unequal length
stay comparable: the share of A's kept hashes that B keeps too estimates how
much of A lies in B, and the union of two sketches is the sketch of both texts
together.  The smallest hash of all is kept beside the sketch, not in it: it tells
texts apart that are too short to have a hash below the threshold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import quoted, spare

WORDS = 5
#: One hash of so many is kept.
SCALE = 8
#: A bucket of neighbours holds the ids that agree but for so many low bits.
BUCKET_BITS = 12


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``df`` plus a struct ``out``: ``hashes``, the sorted distinct hashes that the
    sketch of ``text`` keeps, and ``least``, the smallest hash of all.

    Words are lower-cased and parted by white space; fewer than ``words`` of
    them are one shingle.  A short text may have no hash below the threshold; one
    without words (or null) has no ``least`` either.  Other columns pass through,
    whatever their names; one named ``out`` is replaced.
    """
    rest = quoted([c for c in df.columns if c != out])
    own = spare(df.columns)
    word, every = f"{own}words", f"{own}hashes"
    n = F.size(word)
    each = F.transform(F.sequence(F.lit(0), n - words),
                       lambda i: F.xxhash64(*(F.get(word, i + j) for j in range(words))))
    cut = df.select(*rest, F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"),
                                    lambda w: w != "").alias(word))
    hashed = cut.select(*rest, F.when(n >= words, each).when(
        n > 0, F.array(F.xxhash64(F.array_join(word, " ")))).otherwise(
        F.array().cast("array<long>")).alias(every))
    below = -(1 << 63) + (1 << 64) // scale
    return hashed.select(*rest, F.struct(
        F.array_sort(F.array_distinct(F.filter(every, lambda h: h < F.lit(below)))).alias("hashes"),
        F.array_min(every).alias("least")).alias(out))


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles (Jaccard).  Where neither sketch keeps a
    hash, 1 if the smallest hashes agree (or neither text has words), else 0."""
    x, y = f"{a}.hashes", f"{b}.hashes"
    both = F.size(F.array_intersect(x, y))
    return F.when(F.size(x) + F.size(y) == 0, F.col(f"{a}.least").eqNullSafe(F.col(f"{b}.least")).cast("double")).otherwise(
        both / (F.size(x) + F.size(y) - both))


def containment(a: str, b: str) -> Column:
    """Estimated share of a's shingles that b holds: 1 if a has no words, and null
    if it has some but its sketch keeps none, so that it can't tell."""
    x = f"{a}.hashes"
    return F.when(F.col(f"{a}.least").isNull(), F.lit(1.0)).when(
        F.size(x) > 0, F.size(F.array_intersect(x, f"{b}.hashes")) / F.size(x))


def merged(*sketches: str) -> Column:
    """The sketch of all texts together."""
    return F.struct(F.array_sort(F.array_distinct(F.flatten(F.array(*(f"{s}.hashes" for s in sketches))))).alias("hashes"),
                    F.array_min(F.array(*(f"{s}.least" for s in sketches))).alias("least"))


def rendered(sketch: str) -> Column:
    """A sketch as text: its hashes as 16 hex digits each, comma-joined; the smallest
    hash of a text whose sketch keeps none."""
    kept, least = F.col(f"{sketch}.hashes"), F.col(f"{sketch}.least")
    shown = F.when((F.size(kept) > 0) | least.isNull(), kept).otherwise(F.array(least))
    return F.array_join(F.transform(shown, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def _next_lower(keys: DataFrame, bits: int) -> DataFrame:
    """(k, next): the next lower of the distinct ``k`` (``bits`` bits), null for
    the lowest.  Each step looks at 16 bits, so no window is larger than that,
    however the keys lie."""
    near = Window.partitionBy("up").orderBy(F.desc("k"))
    split = keys.select("k", (F.shiftright("k", 16) if bits > 16 else F.lit(0)).alias("up"))
    own = split.withColumn("next", F.lead("k").over(near))
    if bits <= 16:
        return own.select("k", "next")
    tops = split.groupBy("up").agg(F.max("k").alias("top"))
    ups = _next_lower(tops.select(F.col("up").alias("k")), bits - 16)
    far = (ups.select(F.col("k").alias("from"), F.col("next").alias("up")).join(tops, "up")
           .select(F.col("from").alias("up"), "top"))
    return own.join(far, "up", "left").select("k", F.coalesce("next", "top").alias("next"))


def with_next(docs: DataFrame, doc_id: str, values: list[str], out: str = "next",
              prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` plus a struct ``out`` of the ``values`` of the next document, by
    descending ``doc_id``; after the last comes the first.  ``prepare`` adds
    what ``values`` need beyond the columns of ``docs``, once for each row.

    Ids are whole numbers, so a bucket of 4,096 successive ids bounds the rows
    of a window.  The first row of the bucket below is put behind each bucket's
    last one, and all rows are shuffled once.  Equal ids follow the hash of
    their values; a null id comes last.  Other columns pass through, whatever their
    names; one named ``out`` is replaced.
    """
    own = spare(docs.columns)
    id_, bucket, host, guest = (f"{own}{c}" for c in ("key", "bucket", "host", "guest"))
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(*quoted([c for c in docs.columns if c != out]), key.alias(id_),
                        F.shiftright(key, BUCKET_BITS).alias(bucket))
    tops = materialize(keyed.groupBy(bucket).agg(F.max(id_).alias(id_)))
    first = tops.agg(F.max(bucket)).first()[0]
    order = _next_lower(tops.select(F.col(bucket).alias("k")), 64 - BUCKET_BITS)
    guests = materialize(order.select(F.col("k").alias(host),
                                      F.coalesce("next", F.lit(first)).alias(bucket))
                         .join(tops, bucket).select(id_, host))
    if guests.count() <= 1_000_000:  # 16 bytes each
        guests = F.broadcast(guests)
    columns = quoted([c for c in keyed.columns if c != bucket])
    visiting = (keyed.join(guests, id_)
                .select(*columns, F.col(host).alias(bucket), F.lit(1).alias(guest)))
    window = Window.partitionBy(bucket).orderBy(guest, F.desc(id_), F.xxhash64(*values))
    rows = keyed.select(*columns, bucket, F.lit(0).alias(guest)).unionByName(visiting)
    return (prepare(rows)
            .withColumn(out, F.lead(F.struct(*values)).over(window))
            .where(F.col(guest) == 0).drop(id_, bucket, guest))
