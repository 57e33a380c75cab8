"""Session helpers: cluster-friendly defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on; a cluster's own values win (only unset keys are
# set). Compression and partition-overwrite mode are per-write options, not
# session settings, so a caller's other writes are not affected.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "relaymart") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # catalog tables of a local session live in a scratch folder, not in
        # the current directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="relaymart-warehouse-"))
    )
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a *local* master (tests,
    a laptop) a fresh local folder is created and registered. On a cluster a
    machine-local folder would not be shared, so an unset value is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local context
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="relaymart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/relaymart/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["local_session", "apply_defaults", "ensure_checkpoint_dir", "work_path"]


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a large run (to pass to the session builder).

    * scans: ``maxPartitionBytes`` at the target size, so each task reads a
      bounded slice whatever the table size;
    * shuffles: an initial partition count large enough that each holds about
      one target-size slice of the (at most input-sized) shuffled data, at
      least 3 waves of tasks over all cores; AQE then coalesces small
      partitions to the advisory size and splits skewed ones.
    """
    slices = max(1, -(-input_bytes // target_partition_bytes))
    initial = max(3 * total_cores, slices)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
