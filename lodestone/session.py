"""Session construction and the shared scratch location.

Jobs that materialise data (snapshots, clustered layouts, checkpoints) write
under the folder the cluster names in ``spark.checkpoint.dir``.  A directory
is only created locally when the session has none configured (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  They are applied only
# when building a new session; an existing cluster session keeps its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lodestone", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a folder created.
    Sessions without a SparkContext handle (Spark Connect) use the conf
    value as is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. Spark Connect
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not str(master).startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                                   "(checkpoints and snapshots are written there)")
            # Local mode (tests, laptops) without a configured folder: make one.
            root = tempfile.mkdtemp(prefix="lodestone-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share."""
    return _checkpoint_root(spark).rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{_checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint(df):
    """Reliable checkpoint (cuts lineage, survives executor loss)."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20,
               max_partitions: int | None = None) -> dict:
    """Session settings sized for a cluster run.

    * ``spark.sql.shuffle.partitions``: enough that a shuffle of the whole
      input lands at ~``target_partition_bytes`` per task (AQE then coalesces
      smaller stages) and never fewer than 2 x cores; ``max_partitions`` is a
      bound of the caller's, none by default;
    * scan splits of 256 MB (fewer, larger scan tasks over columnar files);
    * AQE advisory size = the target, skew splitting for partitions 5x the
      median and above 256 MB.

    E.g. 100 TB -> 819,200 shuffle partitions of 128 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = min(parts, max_partitions) if max_partitions else parts
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
