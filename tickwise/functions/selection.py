"""Exact quantiles of groups of any size, by distributed selection.

``percentile`` keeps a group's values in one aggregation buffer.  Here a group
that is larger than ``limit`` is narrowed first: approximate quantiles (mergeable
sketches) give a bracket around the wanted ranks, one count per group tells how
many rows lie below, on and inside the bracket, and only the rows strictly
inside stay.  This repeats until a rank falls on a bracket's end, as it does on
heavy ties, or few enough rows are left to be sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .slices import joined

#: Rows of a group that one task may sort.
LIMIT = 10_000
#: The sketch is asked for so many evenly spaced quantiles; a pass keeps about 3 / STEPS of a group.
STEPS, ACCURACY = 1000, 20_000


def exact_percentile(df: DataFrame, keys: list[str], value: str, q: float, out: str = "percentile",
                     limit: int = LIMIT) -> DataFrame:
    """(keys, ``out``): the linearly interpolated ``q`` quantile of the values that
    are not null or NaN, one row per group; null for a group without values.

    The same number as ``percentile`` gives.  Null keys are groups of their own.
    """
    x = F.col(value).cast("double")
    rows = materialize(df.select(*keys, F.when(~F.isnan(x), x).alias("_x")))
    sizes = materialize(rows.groupBy(*keys).agg(F.count("_x").alias("_n")))
    small = (joined(rows, sizes, keys).where(F.col("_n") <= limit).groupBy(*keys)
             .agg(F.percentile("_x", F.lit(q)).alias(out)))
    place = (F.col("_n") - 1) * F.lit(q)
    # Wanted ranks, from 0, among the rows strictly between _lo and _hi; null: unbounded.
    none = F.lit(None).cast("double")
    wanted = materialize(sizes.where(F.col("_n") > limit).select(
        *keys, (place - F.floor(place)).alias("_part"), none.alias("_lo"), none.alias("_hi"),
        F.explode(F.array(*[F.struct(F.lit(t).alias("t"), f(place).cast("long").alias("k"))
                            for t, f in ((0, F.floor), (1, F.ceil))])).alias("_w"))
        .select(*keys, "_part", "_lo", "_hi", F.col("_w.t").alias("_t"), F.col("_w.k").alias("_k"), none.alias("_v")))
    found = []
    bracket = [*keys, "_lo", "_hi"]
    while wanted.head(1):
        ranges = wanted.select(*bracket).distinct()
        # The large table stays on the left, so that a small one may be sent to it or a hot key be split.
        inside = joined(rows, ranges.withColumn("_here", F.lit(True)), keys).where(
            F.col("_here") & (F.col("_lo").isNull() | (F.col("_x") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_x") < F.col("_hi")))
            & F.col("_x").isNotNull()).drop("_here")
        inside = materialize(inside)
        steps = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
        marks = materialize(inside.groupBy(*bracket).agg(
            F.count(F.lit(1)).alias("_m"), F.percentile_approx("_x", steps, ACCURACY).alias("_q")))
        asked = joined(wanted, marks, bracket)
        # Few rows: sort them.
        few = marks.where(F.col("_m") <= limit).select(*bracket)
        lists = joined(inside, few.withColumn("_few", F.lit(True)), bracket).where("_few").groupBy(*bracket).agg(
            F.sort_array(F.collect_list("_x")).alias("_all"))
        sorted_out = joined(asked.where(F.col("_m") <= limit), lists, bracket).withColumn(
            "_v", F.element_at("_all", (F.col("_k") + 1).cast("int")))
        found.append(sorted_out.select(*keys, "_t", "_part", "_v"))
        # Many: a bracket of two quantiles around each rank, and the rows on either side of its ends.
        share = F.col("_k") / F.greatest(F.col("_m") - 1, F.lit(1)) * STEPS
        at = lambda i: F.element_at("_q", F.least(F.greatest(i, F.lit(0)), F.lit(STEPS)).cast("int") + 1)
        many = asked.where(F.col("_m") > limit).withColumns({"_a": at(F.floor(share) - 1), "_b": at(F.ceil(share) + 1)})
        ends = many.select(*bracket, "_a", "_b").distinct()
        number = lambda c: F.count(F.when(c, 1))
        x, a, b = F.col("_x"), F.col("_a"), F.col("_b")
        counts = joined(inside, ends, bracket).where("_a is not null").groupBy(*bracket, "_a", "_b").agg(
            number(x < a).alias("_n0"), number(x == a).alias("_n1"), number((x > a) & (x < b)).alias("_n2"),
            number((x == b) & (b > a)).alias("_n3"))
        sure = joined(many, counts, [*bracket, "_a", "_b"])
        k, upto = F.col("_k"), [F.col("_n0")]
        for n in ("_n1", "_n2", "_n3"):
            upto.append(upto[-1] + F.col(n))
        sure = materialize(sure.select(
            *keys, "_part", "_t",
            F.when((k >= upto[0]) & (k < upto[1]), a).when((k >= upto[2]) & (k < upto[3]), b).alias("_v"),
            F.when(k < upto[0], F.col("_lo")).when(k < upto[2], a).otherwise(b).alias("_lo"),
            F.when(k < upto[0], a).when(k < upto[2], b).otherwise(F.col("_hi")).alias("_hi"),
            F.when(k < upto[0], k).when(k < upto[2], k - upto[1]).otherwise(k - upto[3]).alias("_k")))
        found.append(sure.where("_v is not null").select(*keys, "_t", "_part", "_v"))
        wanted = sure.where("_v is null").select(*keys, "_part", "_lo", "_hi", "_t", "_k", "_v")
    if not found:
        return small
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    low, high = (F.max(F.when(F.col("_t") == t, F.col("_v"))) for t in (0, 1))
    part = F.max("_part")
    large = values.groupBy(*keys).agg(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(out))
    return small.unionByName(large)
