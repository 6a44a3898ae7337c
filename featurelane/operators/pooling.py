"""Embedding pooling over multivalent columns (R8-R11), as joins + aggregates.

Vectors are handled in long form ``(id, dim, x)``: a weighted pooled vector is
``groupBy(row, dim).sum(x * w)``.  No row ever gathers its item list, and the
embedding table is joined (AQE picks broadcast or shuffle from its size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectors_long(emb: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, dim, x)`` rows from an array column (dim is 0-based)."""
    return emb.select(F.col(id_col).alias("_eid"),
                      F.posexplode(vec_col).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))


def _with_vectors(items: DataFrame, item: str, emb_long: DataFrame) -> DataFrame:
    """Each item with the rows ``(dim, x)`` of its vector; an unknown or null id has the zero vector."""
    last = emb_long.agg(F.max("dim")).first()[0]  # the embedding's width, one number
    dims = F.sequence(F.lit(0), F.lit(last)) if last is not None else F.array().cast("array<int>")
    j = items.join(emb_long.withColumnRenamed("dim", "_d"), F.col(item).cast("long") == F.col("_eid"), "left")
    return (j.withColumn("dim", F.explode(F.when(F.col("_d").isNull(), dims).otherwise(F.array("_d"))))
            .withColumn("x", F.coalesce("x", F.lit(0.0))).drop("_d"))


def weighted_pool(items: DataFrame, row_key: Sequence[str], item: str, weight: str,
                  emb_long: DataFrame) -> DataFrame:
    """``sum_i emb[id_i] * w_i / ||w||_2`` per row (weights of one row L2-normalised).

    Items with no vector (id 0, unknown ids) contribute the zero vector (R10).
    """
    keys = list(row_key)
    norm = items.groupBy(*keys).agg(F.sqrt(F.sum(F.col(weight).cast("double") ** 2)).alias("_norm"))
    w = items.join(norm, keys, "left").withColumn("_w", F.col(weight) / F.col("_norm"))
    j = _with_vectors(w, item, emb_long)
    return j.groupBy(*keys, "dim").agg(F.sum(F.col("x") * F.col("_w")).alias("x"))


def mean_sqrt_pool(items: DataFrame, row_key: Sequence[str], item: str, emb_long: DataFrame) -> DataFrame:
    """``sum_i emb[id_i] / sqrt(len)`` (unit weights, L2-normalised)."""
    keys = list(row_key)
    lens = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("_len"))
    j = _with_vectors(items, item, emb_long)
    s = j.groupBy(*keys, "dim").agg(F.sum("x").alias("_s"))
    return s.join(lens, keys, "left").select(*keys, "dim", (F.col("_s") / F.sqrt("_len")).alias("x"))


def vector_product(a: DataFrame, b: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Element-wise product of two long-form vectors (missing dims are 0)."""
    keys = list(row_key) + ["dim"]
    j = a.withColumnRenamed("x", "_a").join(b.withColumnRenamed("x", "_b"), keys, "full")
    return j.select(*keys, (F.coalesce("_a", F.lit(0.0)) * F.coalesce("_b", F.lit(0.0))).alias("x"))


def to_array(long: DataFrame, row_key: Sequence[str], dims: int) -> DataFrame:
    """Long form -> fixed-length array column (``dims`` is the embedding size)."""
    keys = list(row_key)
    g = long.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("dim", "x"))).alias("_m"))
    return g.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                                       lambda d: F.coalesce(F.element_at("_m", d), F.lit(0.0))).alias("vec"))
