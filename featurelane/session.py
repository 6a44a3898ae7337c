"""Session construction and lineage cutting.

The checkpoint folder always comes from the session (``spark.checkpoint.dir``,
set by the cluster).  Only on a local master may it be unset (tests): a scratch folder
is used then.  On a cluster an unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast joins are chosen by Spark from measured sizes (AQE runtime
    # statistics) below this bound; above it the plan stays a shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # slice and stage checkpoints are deleted once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "featurelane") -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster
    leave them ``None`` so the cluster's settings stay in force.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spill-aware sizing for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 3 waves of the cluster's cores) and AQE coalesces the small
    ones at run time, so a 100 TB job gets about 400k partitions of about 256 MB
    each and a small one is not split into thousands of tiny tasks.  Input
    splits use the same target size.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or the context's directory).  If both are
    unset, a local master gets a fresh scratch folder, any other an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="featurelane-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder (never local) and read it back.

    As Parquet: a reliable checkpoint holds the rows as they lie in memory, uncompressed, and every reader reads all columns.
    What Parquet cannot hold (a void or interval column, equal names) and a lazy cut is checkpointed.
    """
    spark, names = df.sparkSession, [c.lower() for c in df.columns]
    folder = checkpoint_dir(spark).rstrip("/")
    if not eager or not names or len(set(names)) < len(names) or any("void" in t or "interval" in t for _, t in df.dtypes):
        return df.checkpoint(eager=eager)
    path = f"{folder}/cut-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
