"""SparkSession settings for the survey build, and the checkpoint folder.

The job relies on three engine features rather than hand-written scheduling:

* AQE coalesces the many small shuffle partitions of the summary stages and
  splits skewed join partitions (one respondent, station or household may hold
  a large share of the diary rows). ``forceOptimizeSkewedJoin`` lets AQE split a
  hot partition even when the plan downstream relied on the join's
  partitioning; it then adds the shuffle that is needed.
* Broadcasts are bounded by bytes: up front by file sizes (Spark multiplies the
  sizes of a join's sides, so a joined table counts as large), and at run time,
  by AQE, by the measured size of a shuffle.
* A task's memory is bounded by what it reads. One row of the facts becomes up to forty in the
  hash maps of the summaries, some hundred times the bytes that were shuffled, so AQE coalesces
  to 8 MB, not more, and scans read 32 MB. AQE can only merge the partitions that a shuffle begins with,
  so :func:`size_shuffles` has their number follow the size of the input.
* The session time zone is pinned to UTC so date functions do not depend on
  the machine.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once the checkpointed DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # partition values (quarters) are read back as strings, never guessed as numbers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

#: Bytes of the stored tables for each partition that a shuffle begins with; a shuffle of the diary is two to three times its files.
STORED_BYTES_PER_PARTITION = 3_000_000


def get_session(
    master: str | None = None,
    app_name: str = "waveband",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster call it without ``master``; the launcher supplies it. The shuffles are
    sized by :func:`size_shuffles`, and ``spark.sql.shuffle.partitions`` is the least
    that they begin with. Locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("WAVEBAND_DRIVER_MEMORY", "12g"))
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of :data:`DEFAULT_CONF` to an existing session."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Have shuffles begin with a partition for each :data:`STORED_BYTES_PER_PARTITION` of the tables at ``paths``.

    AQE merges those that turn out small, so a task's share stays the same however large the tables are.
    The number is at least ``spark.sql.shuffle.partitions``; returns it.
    """
    stored = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(at):
            stored += files.getContentSummary(at).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // STORED_BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where the session has none.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that folder is
    used as is. Only a local-mode session without the setting (tests) gets a
    fresh folder under the system temp directory. A cluster session without it
    is an error: a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) for checkpoints"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="waveband-ckpt-"))
    return sc.getCheckpointDir()
