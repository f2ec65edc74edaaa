"""tickwise: a Spark-native feature, label and evaluation engine for long
price panels keyed by ``(symbol, date)``.

Every operator is a lazy DataFrame -> DataFrame (or Column -> Column)
function built from Spark SQL built-ins, so Catalyst sees one plan per
query and can prune columns, push filters to the Parquet scan and share
one hash exchange on ``symbol`` between all time-series windows.
"""

__version__ = "0.1.0"
