"""Session construction and the shared work folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Streaming state (window panes, dedup keys) lives in RocksDB off-heap,
# not in executor heap; changelog checkpointing uploads only deltas.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings every tidemark session wants.  AQE re-plans joins from runtime
# sizes (a size-checked broadcast), coalesces small shuffle partitions and
# splits skewed join partitions; UTC keeps zoned casts reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # files with nanosecond timestamps load those columns as LONG instead of
    # failing; ``bronze.read_facts(nanos_columns=...)`` converts them
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    **STATE_CONF,
}


# Extra settings for a real cluster (not applied to local[...] sessions,
# where the data is small and parallelism matters more than task size).
CLUSTER_CONF = {
    # coalesce shuffle partitions to ~128 MB instead of to the core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # split a skewed join partition once it is 5x the median and > 256 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # bounded output files (~128 MB at typical row widths) for downstream scans
    "spark.sql.files.maxRecordsPerFile": "5000000",
    # lost executors: keep shuffle files reachable and retry fetches
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a SparkSession with tidemark's defaults.

    On a cluster leave ``master`` None and let spark-submit decide; size
    ``shuffle_partitions`` to input bytes / ~128 MB (AQE coalesces down).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not (master and master.startswith("local")):
        conf.update(CLUSTER_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, also in a session
    that ``build_session`` did not make; its own settings hold again afterwards.
    A query keeps the settings that it started with, and so does its checkpoint."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, taken from ``spark.checkpoint.dir``.

    On a cluster this is a distributed file system path every executor can
    reach; off-local a missing setting is an error.  Only in a local session
    (tests) do we make a private folder and register it as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run's output."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of the files under ``paths`` in one digest: what
    was derived from an input is reused only while this stays the same."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        root = jvm.org.apache.hadoop.fs.Path(p)
        store = root.getFileSystem(conf)
        for st in store.globStatus(root) or []:
            files = [st] if st.isFile() else list(store.listStatus(st.getPath()))
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return hashlib.sha1(repr(sorted(found)).encode()).hexdigest()[:16]
