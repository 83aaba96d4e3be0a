"""Session settings for tests and benchmarks, and the shared folder for files a job writes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# How a stream of very many micro-batches writes its logs: by the file system's own rename, which costs a fraction of the default
# where that asks for links and rights by commands of the system. One stream at a time may use a checkpoint, as ever.
_LOG_WRITER = "spark.sql.streaming.checkpointFileManagerClass"
LOG_SETTINGS = {_LOG_WRITER: "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}


def log_settings(spark: SparkSession) -> dict[str, str]:
    """Options for starting a stream of very many micro-batches; what the session names itself stays."""
    return LOG_SETTINGS if spark.conf.get(_LOG_WRITER, None) is None else {}


def state_settings(partitions: int | None = None) -> dict[str, str]:
    """Options for starting a stateful stream, which keeps the number of state partitions for ever."""
    return STATE_STORE | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tweetflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the one the cluster names for checkpoints.

    Where it names none, the folder lies in the warehouse, which every executor reaches as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return f"{base.rstrip('/')}/tweetflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set session options for the enclosed block and put the former values back."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
