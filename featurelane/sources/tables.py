"""Reading the driver's Parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def spread(df: DataFrame) -> DataFrame:
    """Spread an under-partitioned scan over the available cores.

    A file written as one row group is read by one task, which then also runs
    every narrow step after the scan (joins' probe side, explode, regex).  When
    the scan has fewer partitions than the cluster has cores, a round-robin
    ``repartition`` fixes that; a large table already has far more input splits
    than cores and is left untouched (no extra shuffle at scale).  Projections
    and filters still reach the scan below the repartition.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet(f"{sf_dir}/{name}.parquet")``."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
