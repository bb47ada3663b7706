"""Session settings, scratch locations and the fixed values of the data model."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# --- fixed values (must equal the source system's values) -------------------
# Change-record operation codes written by the capture connector.
OP_CREATE = "c"
OP_UPDATE = "u"
OP_DELETE = "d"
OP_READ = "r"  # rows read during the connector's initial snapshot

# Topic prefix and the five captured tables, in capture order.
TOPIC_PREFIX = "banking.banking"
TABLES = ["transactions", "customers", "accounts", "transaction_legs", "banks"]

# Accepted values of the operational domains.
ACCOUNT_TYPES = ["current", "savings"]
CHANNELS = ["online", "mobile", "atm", "branch", "card"]
TRANSACTION_TYPES = ["deposit", "withdrawal", "transfer"]
STATUSES = ["pending", "completed", "failed"]
ACCOUNT_STATUSES = ["active", "frozen", "dormant", "closed"]
DIRECTIONS = ["debit", "credit"]
# --- end of fixed values ----------------------------------------------------


def topic_of(table: str) -> str:
    return f"{TOPIC_PREFIX}.{table}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", driver_memory: str = "8g", tz: str = "UTC") -> SparkSession:
    """Session for tests and local benchmarks. A cluster job builds its own
    session; the library itself never creates one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", tz)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is. Only on a local master (tests) may it be unset: a private
    folder is then created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for tables that a job
    writes and reads back (lineage cuts, versioned outputs, stream state)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def prune_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Remove the scratch tables that nothing has written to for that long;
    returns how many. A result DataFrame reads its scratch tables when it is
    used, so they cannot go with the call that made them: jobs call this when
    they begin, with more hours than any of them takes."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/tidemark")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    oldest = (time.time() - older_than_hours * 3600) * 1000
    gone = [st.getPath() for st in fs.listStatus(root) if st.getModificationTime() < oldest]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def data_dir(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
