"""Session construction and the few settings every job depends on."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_own_folders: dict[str, str] = {}
_scratch = threading.local()


def local_session(
    app: str = "zonewise",
    cores: int | str = 8,
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the session comes from spark-submit; nothing in the library
    depends on the values set here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Keep all local cores busy on small inputs.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE_KEY, ROCKSDB_STATE_STORE)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session without that
    setting (a local test run) gets a folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR_KEY} to a folder all executors can reach")
    # The setting cannot be changed while a context runs, so its folder is kept here.
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folders[context.applicationId]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


@contextmanager
def scratch(folder: str) -> Iterator[str]:
    """Inside, ``materialize`` writes tables into ``folder``, for the caller to delete when they are no longer read."""
    before = getattr(_scratch, "folder", None)
    _scratch.folder = folder
    try:
        yield folder
    finally:
        _scratch.folder = before


def materialize(df):
    """Compute ``df`` once into the shared folder and cut its lineage there.

    A reliable checkpoint, or inside ``scratch`` a table: both survive the loss of executors.
    """
    spark = df.sparkSession
    folder = getattr(_scratch, "folder", None)
    if folder is not None:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
