import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]")
         .appName("tickwise-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickwise-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def bars_frame(spark, rows):
    """rows: list of (symbol, date-string, close[, volume[, high, low]])."""
    import datetime as dt
    out = []
    for r in rows:
        sym, d, c = r[0], r[1], r[2]
        vol = r[3] if len(r) > 3 else 100.0
        hi = r[4] if len(r) > 4 else (c if c is None else c + 1.0)
        lo = r[5] if len(r) > 5 else (c if c is None else c - 1.0)
        out.append((sym, dt.date.fromisoformat(d), c, hi, lo, c, float(vol)))
    return spark.createDataFrame(
        out, "symbol string, date date, open double, high double, low double, close double, "
             "volume double")


def day_seq(n, start="2018-01-01"):
    import datetime as dt
    d0 = dt.date.fromisoformat(start)
    return [(d0 + dt.timedelta(days=i)).isoformat() for i in range(n)]
