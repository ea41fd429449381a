"""Session construction and cluster-shared settings."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.
# * Broadcasts are decided at run time only: the plan-time estimate
#   (``spark.sql.autoBroadcastJoinThreshold``) is switched off, and AQE
#   broadcasts a join side only when its *measured* shuffle output is under
#   ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Anything larger stays
#   a sort-merge join, whose skewed partitions AQE splits.
# * AQE coalesces small shuffle partitions toward the advisory size.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # reliable checkpoints (global ranking) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Parquet is about so much smaller than the CSV that bronze is, and what a
#: shuffle moves about so much smaller than the Parquet it was aggregated from.
CSV_TO_COLUMNS, COLUMNS_TO_SHUFFLE = 0.25, 0.5
SPLIT_MB = PARTITION_MB = 512


def scale_settings(input_gb: float, total_cores: int) -> dict[str, str]:
    """Settings for a run over ``input_gb`` of bronze CSV on ``total_cores``.

    A scan task reads about ``SPLIT_MB`` and a shuffle partition holds about
    ``PARTITION_MB`` of pre-aggregated columns, never fewer of them than two
    waves of the cores; AQE merges what turns out smaller. At 100 TB these
    are some 25,000 partitions, a number that a driver can track.
    """
    shuffled = input_gb * 1024 * CSV_TO_COLUMNS * COLUMNS_TO_SHUFFLE
    partitions = max(2 * total_cores, math.ceil(shuffled / PARTITION_MB), 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{SPLIT_MB}m",
    }


def build_session(master: str | None = "local[*]", app_name: str = "shelfwise",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the pipeline's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; pass
    ``extra=scale_settings(...)`` to size partitions to the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used. Only a local-mode session with nothing configured (tests)
    gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-ckpt-"))
    return sc.getCheckpointDir()
