"""Scans and sinks (S1-S10) with declared schemas.

Production reads never infer types: a ``StructType`` (or a ``name -> type``
map) is declared per stage, and per-column defaults fill empty fields.
Paths are Hadoop URIs (``file:``, ``hdfs:``, ``s3a:``, ``gs:`` ...), so the same
code runs locally and on object stores.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: A quote within a value is doubled; a row that does not fit the schema is an error.
CSV = {"quote": '"', "escape": '"'}


def schema_of(fields: dict[str, str] | Sequence[tuple[str, str]]) -> T.StructType:
    """``{'store': 'int', 'date': 'string', ...}`` -> ``StructType`` (DDL types)."""
    items = fields.items() if isinstance(fields, dict) else fields
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in items))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | dict[str, str],
             header: bool = True, defaults: dict[str, object] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV (file, folder or glob) with declared types; empty fields -> defaults.

    ``multi_line`` is for values that hold newlines: such a file cannot be split, so one file is one task.
    """
    if isinstance(schema, dict):
        schema = schema_of(schema)
    df = spark.read.schema(schema).option("header", header).options(**CSV).option("multiLine", multi_line).option("mode", "FAILFAST").csv(path)
    return df.na.fill(defaults) if defaults else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header row, no index column."""
    df.write.mode(mode).option("header", True).options(**CSV).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Persisted stage table (Parquet)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a persisted stage table."""
    return spark.read.parquet(path)


def write_series(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """JSON sink of a series (e.g. the split dates kept apart)."""
    df.select(*cols).write.mode("overwrite").json(path)


def read_series(spark: SparkSession, path: str, schema: T.StructType | dict[str, str]) -> DataFrame:
    """JSON source with declared types."""
    if isinstance(schema, dict):
        schema = schema_of(schema)
    return spark.read.schema(schema).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store its URI names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def save_stats(spark: SparkSession, stats: dict, path: str) -> None:
    """Fitted statistics (a small dict) as one JSON document."""
    spark.createDataFrame([(json.dumps(stats),)], "doc string").coalesce(1).write.mode("overwrite").text(path)


def load_stats(spark: SparkSession, path: str) -> dict | None:
    """Fitted statistics, or ``None`` when absent (callers then skip scaling)."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).take(1)  # unreadable statistics raise
    return json.loads(rows[0][0]) if rows else None


def preview(spark: SparkSession, path: str, n: int = 5, fmt: str = "csv", header: bool = True) -> DataFrame:
    """First ``n`` rows of a file (a limit is the feature here)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", header)
    return r.load(path).limit(n)


def resolve(base: str, *parts: str) -> str:
    """Join a base URI (local folder or object-store bucket) with stage names."""
    return "/".join([base.rstrip("/")] + [p.strip("/") for p in parts])
