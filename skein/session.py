"""Session helpers: settings the engine relies on and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine's semantics rely on: window bounds and ISO parsing
# are defined in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
# Defaults applied only where the session leaves them unset: AQE re-plans
# joins and coalesces shuffle partitions at run time; streaming state lives
# in RocksDB (bounded memory, spills to local disk, checkpointed to the
# shared folder) with changelog checkpointing.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Spark's own defaults of those keys: a key still holding it (and not given
# at start-up) counts as unset.
_SPARK_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}
ENGINE_CONF = {**DEFAULT_CONF, **REQUIRED_CONF}


def is_local(master: str) -> bool:
    """One process: not a cluster, and not ``local-cluster`` with its separate executors."""
    return master == "local" or master.startswith("local[")


def build_session(master: str = "local[8]", app: str = "skein", **conf) -> SparkSession:
    """Session for tests, bench and local runs.

    Without ``spark.checkpoint.dir`` a local session gets a local folder; a
    cluster session is refused, as it must name a folder that all share.
    """
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(ENGINE_CONF)
    settings.update(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        }
    )
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    if "spark.checkpoint.dir" not in settings:
        if not is_local(master):
            raise RuntimeError(f"master {master}: spark.checkpoint.dir must name a shared folder")
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="skein-ck-")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    sc = _context(spark)
    for key, value in DEFAULT_CONF.items():
        if sc is not None and sc.getConf().contains(key):
            continue
        if spark.conf.get(key, None) in (None, "", _SPARK_DEFAULTS.get(key)):
            spark.conf.set(key, value)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local context
        return None


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints, snapshots and sinks, shared by all executors.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session without one
    gets a fresh local folder (tests, the driver's checks); a cluster session
    without it is an error, since a machine-local folder does not survive the
    loss of that machine.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not is_local(master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; the engine needs a shared folder"
            )
        root = tempfile.mkdtemp(prefix="skein-ck-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    """Total task slots of the cluster (local: the thread count)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "8"))


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused path under the shared folder."""
    return "/".join([shared_root(spark), *parts, uuid.uuid4().hex])


def state_partitions(spark: SparkSession, path: str, target_bytes: int = 256 << 20) -> int:
    """Partitions of a stream's state, fixed at its first start: one for each ``target_bytes`` of input
    files (their lengths only are read), and one per task slot at least."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = files.agg({"length": "sum"}).first()[0] or 0
    return max(default_parallelism(spark), -(-size // target_bytes))
