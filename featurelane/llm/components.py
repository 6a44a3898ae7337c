"""Connected components of links by alternating large-star and small-star steps.

Each step is an aggregate and a join on the node; a node's neighbours are never
collected, and the minimum of a hot node's neighbours is combined before the shuffle.
The number of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.llm.stages import few, stage


def _each(edges: DataFrame, *ends: Column) -> DataFrame:
    """A row (u, v) for each of the structs ``ends`` of every row: one pass over the edges and their partitions as they are."""
    return edges.select(F.explode(F.array(*ends)).alias("_e")).select("_e.u", "_e.v")


def _end(u: str, v: str | None) -> Column:
    return F.struct(F.col(u).alias("u"), (F.lit(None).cast("long") if v is None else F.col(v)).alias("v"))


def _large(edges: DataFrame) -> DataFrame:
    both = _each(edges, _end("u", "v"), _end("v", "u"))
    least = (both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
             .select("n", F.least("n", "m").alias("m")))
    return (both.join(least, both["u"] == least["n"]).where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    return _each(down.join(least, down["u"] == least["n"]), _end("v", "m"), _end("u", "m")).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node is below two others, or below one and above another."""
    ends = _each(edges, _end("u", "v"), _end("v", None))
    per = ends.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.col("v").isNull()).alias("above"))
    return not per.where("lo <> hi or (above and lo is not null)").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v longs, staged): root is the least node reachable."""
    edges = few(links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v"))
    while True:
        edges = few(stage(_small(_large(edges)), "stars"))
        if _settled(edges):
            break
    roots = _each(edges, _end("u", "v"), _end("v", "v")).distinct()
    return roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
