"""Session settings and staging of intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators count on.  The skew setting matters most: without it AQE
# leaves a skewed join whole whenever the following aggregation reuses the join's partitioning,
# which is exactly the shape "events join anchors, then group by entity".
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Settings a session has to be started with.  Recording the Python call site of every Column costs
# several milliseconds each, which adds up in matrices with hundreds of expressions.
START_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def start_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended start-up settings to a session builder."""
    for key, value in {**START_SETTINGS, **RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder


def prepare(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive settings the operators are designed around."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set on the context, else one in the warehouse.

    Every executor must be able to reach it, which holds for the warehouse of any cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging").rstrip("/")


_scopes: list[str] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A folder for everything staged inside the ``with`` block; it is deleted at the end.

    Collect or write results before leaving the block: DataFrames over staged tables end with it.
    """
    scope = f"{shared_folder(spark)}/wardgrid/run-{uuid.uuid4().hex}"
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        path = spark._jvm.org.apache.hadoop.fs.Path(scope)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now, not when the driver next collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def storage_memory(spark: SparkSession) -> int:
    """Bytes that may be kept in memory now, over all executors; the driver's share is counted with them."""
    shares = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    total = 0
    while shares.hasNext():
        total += shares.next()._1()
    return total


def staging_path(spark: SparkSession, name: str = "stage") -> str:
    """A fresh path below the shared folder, inside the innermost ``staging`` block if there is one."""
    base = _scopes[-1] if _scopes else f"{shared_folder(spark)}/wardgrid"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the joins) and gives
    the optimizer the true size, so a following join broadcasts only what is really small.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
