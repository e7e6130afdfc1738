"""Session helpers: a configured local session for tests and the shared work folder.

The library never picks a machine-local folder on a cluster: the shared folder is the one
named by ``spark.checkpoint.dir``. Only when the session has none (tests, a laptop) is a
fresh temporary folder set as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """Session used by tests and the bench: UTC, AQE on, no UI."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``total_cores`` executor cores.

    Shuffle partitions are sized so that one partition of the largest shuffle (the range
    sort of the change set, or the bucket rewrite) stays near ``target_partition_bytes``
    and fits in executor memory; AQE coalesces small ones and splits skewed join
    partitions at run time. Example: 100 TB on 1,000 executors x 8 cores gives about
    400,000 shuffle partitions of 256 MiB.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Sets a temporary one
    only on a local master, as in tests; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(folder)
    return (sc.getCheckpointDir() or folder).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"
