"""Session defaults and lineage-cutting helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Defaults a job sets when the cluster has not: adaptive execution re-plans
# joins and partition counts from runtime sizes; skew join splits hot keys.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # persisted intermediates (rank inputs, the train split) keep AQE's
    # partition coalescing; without it a cached plan runs every shuffle at
    # spark.sql.shuffle.partitions tasks
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}

# SQL settings the library relies on; applied to a given session only where
# the session leaves them unset (a cluster's explicit choice wins).
RUNTIME_DEFAULTS = {
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ratelens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the given one."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def prepare_session(spark: SparkSession) -> str:
    """Runtime defaults (where unset) and the checkpoint folder."""
    apply_runtime_defaults(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without one (tests) gets a folder of its own: on a
    cluster a folder of the driver's machine is not the executors' folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ratelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet below the checkpoint folder: for tables that are read often, a few columns at a time."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    names = [f for f in df.schema.fields if f.name != partition_by] + [f for f in df.schema.fields if f.name == partition_by]
    read = df.sparkSession.read.schema(StructType(names)).parquet(path)
    read.stored_at = path
    return read


def discard(df: DataFrame) -> None:
    """Delete a table that ``store`` wrote, once nothing reads it any more."""
    sc = df.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of the query that wrote them, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles and cached blocks that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
