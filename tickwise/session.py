"""Session defaults for local runs and tests.

On a cluster the session is provided by the platform; :func:`tune` only
fills settings that are still unset, and :func:`ensure_checkpoint_dir`
keeps a checkpoint directory that the cluster already names.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every tickwise plan relies on.  AQE re-plans joins with runtime
# sizes (a side is broadcast only when its measured size is below the
# threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickwise") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(cpus)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TICKWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        # per-symbol window stages are CPU-heavy over few rows: let AQE keep
        # one partition per busy key instead of merging them into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Write a reused intermediate as Parquet into the session's shared
    checkpoint folder and return a DataFrame that reads it back.

    Every branch scans the file (column pruning and filters reach it), and a
    lost executor re-reads it instead of recomputing the lineage.  The folder
    goes when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


_SHARED: dict[tuple, DataFrame] = {}


def shared(spark: SparkSession, name: str, tables: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, written once a session and read again by later callers.

    The result belongs to the state of ``tables`` (paths): with a file that
    changed, or in another session, it is built anew."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def state(path: str) -> tuple:
        where = hadoop(path)
        files = where.getFileSystem(conf).globStatus(hadoop(f"{path}/*")) if where.getFileSystem(conf).getFileStatus(
            where).isDirectory() else [where.getFileSystem(conf).getFileStatus(where)]
        return (path, *sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))

    key = (spark.sparkContext.applicationId, name, *(state(t) for t in tables))
    if key not in _SHARED:
        _SHARED[key] = materialize(build())
    return _SHARED[key]


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`DEFAULTS` where the session leaves them unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    The folder that the cluster names (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``) always wins.  Only a single-process local run without
    one gets a scratch folder; on a cluster that is an error, because the
    executors could not see a folder of the driver's.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tickwise-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
