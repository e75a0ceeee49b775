"""Session settings and the shared folder used for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers each that may be broadcast: some tens of megabytes.
BROADCAST_ROWS = 500_000

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

#: Settings every job relies on. Memory and core counts belong to the cluster.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Keeps large stream state out of the executor heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session with ``JOB_SETTINGS``; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="basketry-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark drops the shuffle files of a SQL execution when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, an execution's shuffle files go when it ends, not when the driver's memory is
    cleaned. For executions that nothing reuses, like the writing of a step."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later stages, and recomputation after a lost executor, start from the files. Unlike a
    checkpoint the table is columnar, so its readers prune columns and know its size.
    """
    path = scratch_path(df.sparkSession, label)
    with short_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as the broadcast side of a join when its known bound ``rows`` allows it; beyond
    that Spark joins by shuffling."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
