"""Session set-up and the shared work folder.

The library never picks a machine-local folder on its own: every table it writes for
its own use (staging, checkpoints, registered-query outputs) lives under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset (local runs, tests)
is a fresh temporary folder chosen and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_UTC = "UTC"


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app_name: str = "eventweave", extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": _UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def scale_conf(input_bytes: int, *, cores: int, shuffled_fraction: float = 0.1, target_partition_bytes: int = 256 << 20,
               scan_split_bytes: int = 512 << 20, most_partitions: int = 40_000) -> dict[str, str]:
    """Settings sized for an input volume (e.g. 100 TB on a 1000-executor cluster).

    The initial shuffle width follows the bytes that are *shuffled* (filters, projections and
    partial aggregates leave a fraction of the input): one partition per
    ``target_partition_bytes``, at least 2x the cores and at most ``most_partitions``, beyond
    which the map outputs' status on the driver and the number of blocks (maps x partitions)
    cost more than larger partitions do. AQE coalesces small partitions to the advisory size
    and splits skewed ones; what exceeds memory in the others spills.
    """
    wanted = -(-int(input_bytes * shuffled_fraction) // target_partition_bytes)
    partitions = min(max(2 * cores, wanted), max(most_partitions, 2 * cores))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # Broadcast only what is measured to be small.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every operator relies on; safe to call on any session."""
    # H4: all ISO text <-> timestamp conversions are done in UTC.
    spark.conf.set("spark.sql.session.timeZone", _UTC)
    # A repeated key in an event does not make it malformed; the last value counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set to a new temporary one only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="eventweave-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique (not yet created) folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/eventweave/{name}-{uuid.uuid4().hex[:12]}"
