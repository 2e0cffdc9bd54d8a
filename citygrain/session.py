"""Session helpers: runtime settings the operators count on and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Largest frame, in bytes, that an operator broadcasts after measuring it.
BROADCAST_BYTES = 64 * 1024 * 1024

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A fact row set with one dominant key is split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Long texts make a batch of many rows large, in the JVM's direct memory and in the Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # The ids that a stream remembers live on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


#: Python workers outlive a stage. What is freed in pieces above 4 MiB goes back to the system at once, so
#: that a worker which waits for the next stage doesn't hold the memory of the last.
WORKER_ENVIRONMENT = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive features that the joins of this package rely on, and bound Python workers."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in WORKER_ENVIRONMENT.items():
        spark.sparkContext.environment.setdefault(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder that the cluster names; pick one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="citygrain-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written once, and survive the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Folders named by ``shared_folder`` inside a ``scratch`` block.
_folders: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, for one run, inside the checkpoint folder that all executors see."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _folders.append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what operators staged inside the block when it ends; results must be written elsewhere by then."""
    begin = len(_folders)
    try:
        yield
    finally:
        for folder in _folders[begin:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        del _folders[begin:]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several results read, and read it back.

    Each reader then scans its own columns only, and a lost executor costs nothing.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size, before anything is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Size up to which Spark broadcasts a join side by itself, in bytes."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
