"""Session helpers: settings for this workload, and where shared scratch data goes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # State is read and written in small messages between JVM and Python worker: over a
    # domain socket the whole flow took 27 s on test data, over TCP 42 s.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app: str = "leafmill", **extra: str) -> SparkSession:
    """A session with the settings above; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(
    spark: SparkSession, drain: bool = False, state_partitions: int | None = None
) -> SparkSession:
    """A sibling session with streaming settings, so that the caller's stay as they are.

    ``drain`` is for runs that stop once the input is used up. State with a time-to-live
    asks for one more empty batch for ever; without empty batches such a run ends. A
    standing query keeps them, as they are what fires its timers.

    ``state_partitions`` is how many state stores a stateful query has. Its checkpoint freezes
    the number, so it is a choice for the life of the query and is never taken from the machine;
    left out, it is the number of shuffle partitions.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not drain).lower())
    # A micro-batch too large to be broadcast sends a bloom filter of its keys ahead to the stored table's scan.
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "64MB")
    # Contents and offers meet narrow rows: these are hashed where a partition of them is small, the wide ones are not sorted.
    session.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    # What a step of a micro-batch shuffled is no use to the next, which reads tables or what is persisted; it would stay until the driver collects garbage.
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # RocksDB would reserve some 4 MB of disk for every state partition, far more than its state takes.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    for key in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.session.timeZone"):
        session.conf.set(key, SETTINGS[key])
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive plans for the batch work of a stateful query, as far as the application has not switched them off.

    Spark switches them off for the whole session of such a query, as state must stay where it is. What
    ``foreachBatch`` does with a batch, whose rows are planned by then, has no state.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.sparkContext.getConf().get(key, "true"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A fresh folder below ``root``, or ``spark.checkpoint.dir``, which every executor can reach.

    Only a session whose executors are threads of the driver may do without: it gets a local
    folder. On a cluster such a folder would lose rows, so a missing setting is an error.
    """
    try:
        root = root or spark.conf.get("spark.checkpoint.dir", None)
    except PySparkException:
        pass
    root = root or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="leafmill-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
