"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

# The functions travel with their tasks: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Bounds one Arrow batch in a Python worker, whatever the length of the texts.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, with the batch bounds set."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_batches(spark: SparkSession) -> None:
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def append(df: DataFrame, source: str, name: str, kind: DataType,
           start: Callable[[], Callable[[list], list | pa.Array]]) -> DataFrame:
    """``df`` plus a column ``name``: a function of the column ``source``.

    ``start()`` runs once a task and returns the function, which gets the
    values of an Arrow batch as a list and returns as many results (or an array).  All other
    columns pass through untouched, so no join is needed to bring them back.
    """
    schema = StructType([f for f in df.schema.fields if f.name != name] + [StructField(name, kind)])
    kept = [f.name for f in schema.fields[:-1]]
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            made = made or start()
            out = made(batch.column(source).to_pylist())
            out = out if isinstance(out, pa.Array) else pa.array(out, type=arrow)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out], [*kept, name])

    return df.mapInArrow(run, schema)


def spare(columns: list[str]) -> str:
    """A prefix that no column's name has, for columns of a function's own."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def quoted(columns: list[str]) -> list[str]:
    """The columns' names, also where they hold a dot."""
    return [f"`{c}`" for c in columns]


def held_out(doc_id):
    """True for the quarter of the documents whose labels no model may see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
