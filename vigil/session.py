"""Session construction and the shared checkpoint folder.

On a cluster the deployment names a shared folder in ``spark.checkpoint.dir``;
we read it from the session and only create our own (a fresh temp folder) when
it is unset, which is the local/test case.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock, AQE for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast conversion), no UI.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster reading ~100 TB of parquet. Input splits of
# 512 MB give ~200k scan tasks; the initial shuffle width is generous and AQE
# coalesces it to ~256 MB partitions at runtime, so no reducer has to hold
# more than it can sort in memory, and partitions over 5× the median (and
# 1 GB) are split by the skew-join rule. Range-partitioned prefix sums use the
# shuffle width as their partition count.
CLUSTER_PROFILE = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    # Auto-broadcast only below 64 MB of estimated size; explicit broadcasts
    # in the code are limited to sides bounded by construction.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_session(master: str | None = None, app: str = "vigil",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` applies :data:`CLUSTER_PROFILE` (set before the
    explicit ``shuffle_partitions``/``extra``, which win)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if profile == "cluster":
        settings.update(CLUSTER_PROFILE)
    for k, v in settings.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, registering it with the
    SparkContext. Only a local master may leave it unset (tests): we then
    create a private temp folder; on a cluster that folder would not be shared,
    so an unset one is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder, survives executor
    loss). Used between the expensive phases of multi-stage jobs."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
