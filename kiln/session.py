"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a
shared file system every executor can reach); without that setting a cluster
session is refused.  Only a ``local`` master (tests, the bench) gets one under
the system temp folder, registered so that ``DataFrame.checkpoint()`` works.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "kiln",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for these operators.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast
    conversion from real sizes).  ``shuffle_partitions`` defaults to the
    local core count; on a cluster pass a value sized so one partition holds
    roughly 128-256 MB of shuffle data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is None and master and master.startswith("local"):
        inner = master[len("local["):-1] if "[" in master else "1"
        shuffle_partitions = os.cpu_count() if inner in ("*", "") else int(inner)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    * scan splits of ``partition_bytes`` (one task reads ~256 MB);
    * as many shuffle partitions as input splits (at least 2 per core); AQE coalesces them down to the advisory size
      after each map stage, so a stage that filtered or projected most of
      its input runs few, well-filled reducers;
    * a reducer partition several times the advisory size counts as skewed
      and is split (joins) or rebalanced (writes).
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset, a local
    master gets a temp folder; any other master is an error, because its
    executors could not see a folder of the driver's machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kiln-scratch-")
        spark.conf.set(CHECKPOINT_CONF, root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
