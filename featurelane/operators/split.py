"""Train / validation splits that respect time.

Positions come from the skew-safe :func:`number_within`; group sizes from a
partial aggregation; the activity quantiles are two scalars.  No group is ever
gathered into one task, however large one user's history is.  The activity split, which keeps
a bounded number of a user's rows, leaves the others out before rows move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.operators.ordered import exact_quantiles, number_within
from featurelane.session import cut_lineage


def _desc(order: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).desc() for c in order]


def group_sizes(df: DataFrame, key: str | Sequence[str], name: str = "n") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    for k in keys:  # a null is no group
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def size_distribution(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``groupby(key).size().describe()`` -- count, mean, std, min, quartiles, max."""
    sizes = group_sizes(df, key)
    moments = sizes.agg(F.count("n").cast("double").alias("count"), F.avg("n").alias("mean"),
                        F.stddev_samp("n").alias("std"), F.min("n").cast("double").alias("min"),
                        F.max("n").cast("double").alias("max"))
    qs = exact_quantiles(sizes, [], "n", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return _one_row_merge(moments, qs)


def _one_row_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put two one-row frames side by side (union + max, no cross join)."""
    cols_a, cols_b = a.columns, b.columns
    left = a.select(*cols_a, *[F.lit(None).cast("double").alias(c) for c in cols_b])
    right = b.select(*[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in cols_a], *cols_b)
    return left.unionByName(right).agg(*[F.max(c).alias(c) for c in cols_a + cols_b])


def activity_bounds(df: DataFrame, key: str, lo_q: float = 0.25, hi_q: float = 0.75) -> tuple[int, int]:
    """int() of the lower / upper quantile of rows per key (two scalars)."""
    return size_bounds(group_sizes(df, key), "n", lo_q, hi_q)


def size_bounds(sizes: DataFrame, name: str, lo_q: float = 0.25, hi_q: float = 0.75) -> tuple[int, int]:
    """:func:`activity_bounds` of a table of sizes."""
    q = exact_quantiles(sizes, [], name, [lo_q, hi_q], ["lo", "hi"]).first()
    if q["lo"] is None:  # empty log: nothing to keep
        return 1, 0
    return int(q["lo"]), int(q["hi"])


def activity_split(log: DataFrame, key: str, order: Sequence[str | Column], valid: float = 0.1,
                   lo_q: float = 0.25, hi_q: float = 0.75, split_col: str = "split") -> DataFrame:
    """Keep keys with at least int(q_lo) rows, each key's latest int(q_hi) rows;
    the first ``int(len * (1 - valid))`` of those (in time order) are train."""
    sizes = cut_lineage(group_sizes(log, key, "_n"))  # stage end: read for the bounds and for the lengths
    lo, hi = size_bounds(sizes, "_n", lo_q, hi_q)
    ranked = _latest(log, key, order, hi, "_rd")
    j = ranked.join(sizes.where(F.col("_n") >= lo), key, "inner")
    j = j.withColumn("_len", F.least(F.col("_n"), F.lit(hi).cast("long"))).where(F.col("_rd") <= F.col("_len"))
    train = (F.col("_len") - F.col("_rd") + 1) <= (F.col("_len") * F.lit(1.0 - valid)).cast("long")
    return j.withColumn(split_col, F.when(train, "train").otherwise("valid")).drop("_n", "_rd", "_len")


def _latest(log: DataFrame, key: str, order: Sequence[str | Column], n: int, rank_col: str) -> DataFrame:
    """Each key's newest ``n`` rows at least, with ``rank_col`` = 1 for the newest; a null is no key.

    Spark keeps each input task's newest ``n`` rows of a key before the shuffle (WindowGroupLimit), so a key has at most ``n`` rows from
    each of them, however many it has in the log.  It does so up to a limit of its own; beyond that rows are numbered in slices.
    """
    rows = log.where(F.col(key).isNotNull())
    if n > int(log.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return number_within(rows, [key], _desc(order), rank_col)
    return rows.withColumn(rank_col, F.row_number().over(Window.partitionBy(key).orderBy(*_desc(order))).cast("long")).where(F.col(rank_col) <= n)


def chrono_split(log: DataFrame, key: str, order: Sequence[str | Column], valid: float = 0.3,
                 split_col: str = "split") -> DataFrame:
    """Per key, the last ``int(n * valid)`` rows by time are validation."""
    sizes = group_sizes(log, key, "_n")
    ranked = number_within(log, [key], order, "_ra").join(sizes, key, "inner")
    cut = F.col("_n") - (F.col("_n") * F.lit(float(valid))).cast("long")
    return ranked.withColumn(split_col, F.when(F.col("_ra") <= cut, "train").otherwise("valid")).drop("_n", "_ra")


def latest_n(log: DataFrame, key: str, order: Sequence[str | Column], n: int, rank_col: str = "rn") -> DataFrame:
    """Each key's newest ``n`` rows (``pipe[-n:]``), ``rank_col`` = 1 for the newest."""
    return number_within(log, [key], _desc(order), rank_col).where(F.col(rank_col) <= n)
