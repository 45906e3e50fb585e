"""Session helpers: test-table reader, durable lineage cut, plan size estimate."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only for local masters."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="sidweave-checkpoint-")
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and freezes partition contents."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Settings that the joins here count on when one key holds a large share of all rows.
SKEW_SETTINGS = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
                 # a hot partition is split even where an aggregate on the same key behind the join then needs an exchange
                 "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Set SKEW_SETTINGS; call it once where a job's session is made."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def plan_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a plan, used to gate explicit broadcasts."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def broadcast_limit(spark: SparkSession) -> int:
    """Upper bound for a build side: the session's own threshold (-1 switches broadcasts off)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = str(raw).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    value = int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)
    return min(value, DEFAULT_BROADCAST_BYTES)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints, so that every executor can reach it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/work-{uuid.uuid4().hex}/{name}"


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this job that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def one_row_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside give Python one row at a time: for tables whose single rows fill some MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


SPREAD_MIN, SPREAD_PER_CORE = 256 * 1024, 64 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a small input over the cores.

    A file of one row group is read by one task however many cores there are. Inputs of 64 MB per core
    or more fill the cluster by themselves and pass through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(df)
    return df.repartition(cores) if SPREAD_MIN < size < cores * SPREAD_PER_CORE else df
