"""Batches and padding (W5, W6) for array columns.

Batches are consecutive runs of ``size`` rows in a declared order; numbering is
the skew-safe global :func:`number_within`.  Padding needs each batch's longest
array: a window over ``batch_id`` -- every batch holds at most ``size`` rows, so
that window is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.functions.arrays import pad_to
from featurelane.operators.ordered import number_within


def batches(df: DataFrame, order: Sequence[str | Column], size: int, name: str = "batch_id") -> DataFrame:
    """``batch_id = (row_number - 1) // size`` over a total order."""
    n = number_within(df, [], order, "_rn")
    return n.withColumn(name, ((F.col("_rn") - 1) / size).cast("long")).drop("_rn")


def pad_in_batch(df: DataFrame, col: str, batch: str = "batch_id", fill=0) -> DataFrame:
    """Pad arrays with ``fill`` at the end to the longest array of their batch."""
    w = Window.partitionBy(batch)
    return df.withColumn(col, pad_to(col, F.max(F.size(col)).over(w), fill))
