"""Session set-up shared by jobs, tests and the registered queries."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_RUNTIME_DEFAULTS = {
    # Every time computation in the engine is defined in UTC; the zone is
    # captured when a plan is resolved, so this must be set before any read.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target ~128 MB post-shuffle partitions; AQE coalesces small ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state (open windows per symbol) in RocksDB instead of the
    JVM heap - for feeds with many symbols. Applies to queries started
    afterwards; an existing checkpoint keeps the provider it was created with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


def get_session(master: str | None = None, app: str = "candlewick",
                shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in _RUNTIME_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to an existing session."""
    for k, v in _RUNTIME_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting (tests, the bench) gets a fresh scratch
    folder; on a cluster a missing setting is an error, never a local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="candlewick-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


BROADCAST_ROW_LIMIT = 100_000


def bounded_broadcast(df, rows: int, limit: int = BROADCAST_ROW_LIMIT):
    """Broadcast ``df`` only when its row count - known on the driver from
    configuration, not from the data - is within ``limit``; otherwise leave
    the join strategy to Spark (sort-merge / AQE)."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if rows <= limit else df
