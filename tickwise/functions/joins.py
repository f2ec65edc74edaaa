"""Join helper with an explicit size check.

Without column statistics Spark estimates the size of a join's output as the
product of its inputs, so a dimension mapping built from two joins can look
larger than the fact table it is joined to; the planner then broadcasts the
fact table.  :func:`broadcast_if_small` decides from the row count of the base
table behind the mapping (a Parquet footer count, no data is read) and the
width of the mapping's rows.  Computed sides are left to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 128 << 20
# A row of a broadcast relation: object and hash slot besides its values.
ROW_OVERHEAD = 48


def broadcast_if_small(df: DataFrame, base: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its rows fit ``max_bytes``, else ``df``, which the
    planner then joins by a shuffle.

    ``base`` is a landed table with at least as many rows as ``df`` (the
    dimension that a key -> attribute mapping is built from by N:1 joins).
    """
    width = ROW_OVERHEAD + sum(f.dataType.jsonValue() == "string" and 40 or 8 for f in df.schema.fields)
    return F.broadcast(df) if base.count() * width <= max_bytes else df
