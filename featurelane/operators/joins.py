"""Joins and lookups.

Broadcast only where the small side has a proven bound (``bounded=True``: a
fixed category list, a one-row statistics table).  Everything else is a plain
join: AQE measures the shuffled sizes at runtime, turns it into a broadcast
join when the side really is small, and otherwise keeps a sort-merge join with
skew splitting -- a size check with a fallback, done by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "left",
             bounded: bool = False) -> DataFrame:
    """Enrich a fact table with a dimension table."""
    return fact.join(F.broadcast(dim) if bounded else dim, on, how)


def semi_join(fact: DataFrame, keys: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """``isin(dim.key)`` as a left-semi join (no duplicates, no columns added)."""
    return fact.join(keys, on, "left_semi")


def group_stat_rows(df: DataFrame, keys: Sequence[str], value: str, name: str, fn=F.avg) -> DataFrame:
    """Group statistic attached to every row (aggregate, then join back).

    The aggregate is partial (map-side), the join-back is balanced by AQE; a
    ``avg() over (partition by k)`` window would instead sort a hot key in one task.
    """
    stats = df.groupBy(*keys).agg(fn(value).alias(name))
    return df.join(stats, list(keys), "left")


def lookup_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Serving-time lookup of a saved ``key -> statistic`` table."""
    return df.join(stats, list(keys), "left")


def fat_join(log: DataFrame, users: DataFrame, items: DataFrame, user_key: str, item_key: str,
             raw_keys: bool = True) -> DataFrame:
    """Log left-join user profile and item profile; raw key copies first."""
    out = log
    if raw_keys:
        out = out.withColumn(f"raw_{user_key}", F.col(user_key)).withColumn(f"raw_{item_key}", F.col(item_key))
    out = out.join(users, user_key, "left").join(items, item_key, "left")
    return out
