"""Exploration aggregates (A9-A22, T2-T8): describe, pivots, box plots,
histograms, correlations, trend lines, top-k reports.

Quantiles are exact and distributed (:func:`exact_quantiles`); everything else
is one grouped aggregation with partial (map-side) combine.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.operators.ordered import _key_join, exact_quantiles


def _with_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows whose group keys are all there: a null is no group."""
    for k in keys:
        df = df.where((k if isinstance(k, Column) else F.col(k)).isNotNull())
    return df


def value_counts(df: DataFrame, col: str | Column, name: str = "cnt") -> DataFrame:
    """Occurrences per value (order by ``cnt desc`` when reporting)."""
    return _with_keys(df, [col]).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def having_count(df: DataFrame, keys: Sequence[str], min_count: int, name: str = "cnt") -> DataFrame:
    """Groups with at least ``min_count`` rows."""
    return _with_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) >= min_count)


def top_k(df: DataFrame, order: Sequence[Column], k: int, offset: int = 0) -> DataFrame:
    """``[offset:offset+k]`` of a sorted table; Spark keeps per-task top
    lists (TakeOrderedAndProject), so only ``k + offset`` rows per task move."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(k)


def _draw(df: DataFrame, seed: int, key: Sequence[str]) -> list[Column]:
    """A seeded random order: md5 of seed and row key, then the key itself; the same for every partitioning."""
    key = list(key) or df.columns
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return [F.md5(F.concat_ws("|", F.lit(str(seed)), *text)), *[F.col(c) for c in key]]


def random_sample(df: DataFrame, n: int, seed: int = 42, key: Sequence[str] = ()) -> DataFrame:
    """T4: n rows without replacement; the draw depends on the seed and the row key (all columns by default) alone."""
    return df.orderBy(*_draw(df, seed, key)).limit(n)


def shuffle_rows(df: DataFrame, seed: int = 42, key: Sequence[str] = ()) -> DataFrame:
    """T5: full shuffle before training export, repeatable like :func:`random_sample`."""
    return df.orderBy(*_draw(df, seed, key))


def buffered_shuffle(df: DataFrame, key: Sequence[str], seed: int = 42, buffers: int = 64) -> DataFrame:
    """T5: rows in a seeded random order, ``buffer`` by ``buffer``, with their place ``pos`` in it.

    A row's buffer and place follow from the MD5 of the seed and its key alone, so the order is the same for any
    number of partitions and after a lost executor.  Rows move once, to their buffer; there is no global sort.  Buffers are
    even (the key names a row), so one holds about a ``1 / buffers`` part: take more of them for more rows.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    out = df.withColumn("_md5", F.md5(F.concat_ws("|", F.lit(str(seed)), *text).cast("binary")))
    out = out.withColumn("buffer", F.pmod(F.conv(F.substring("_md5", 1, 8), 16, 10).cast("long"), F.lit(buffers)).cast("int"))
    place = F.row_number().over(Window.partitionBy("buffer").orderBy("_md5", *key))
    return out.withColumn("pos", place.cast("long")).drop("_md5")


def describe(df: DataFrame, value: str | Column, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max, sum = count * mean."""
    keys = list(keys)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*keys, v.alias("_x"))
    # the sum is accumulated as a DECIMAL: exact, so it does not depend on the
    # order in which partitions are added (a double sum of 1e5 prices does)
    mom = base.groupBy(*keys).agg(F.count("_x").cast("double").alias("count"), F.avg("_x").alias("mean"),
                                  F.stddev_samp("_x").alias("std"), F.min("_x").alias("min"),
                                  F.max("_x").alias("max"),
                                  F.sum(F.col("_x").cast("decimal(38,10)")).cast("double").alias("sum"))
    qs = exact_quantiles(base, keys, "_x", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    if keys:
        return _key_join(mom, qs, keys, [])
    from featurelane.operators.split import _one_row_merge
    return _one_row_merge(mom, qs)


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their group's statistics; without keys these are one row, applied as literals."""
    if keys:
        return _key_join(df, stats, keys, [])
    row = stats.first()
    return df.select("*", *[F.lit(row[f.name] if row else None).cast(f.dataType).alias(f.name) for f in stats.schema])


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, mean and 1.5 IQR whiskers (extreme values inside the fences), over all rows without keys."""
    keys = list(keys)
    base = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    qs = exact_quantiles(base, keys, "_x", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    j = _with_stats(base, qs, keys)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.avg("_x").alias("mean"),
        F.min(F.when(F.col("_x") >= lo_f, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= hi_f, F.col("_x"))).alias("whisker_hi"),
        F.sum(F.when((F.col("_x") < lo_f) | (F.col("_x") > hi_f), 1).otherwise(0)).alias("n_outliers"))


def histogram(df: DataFrame, facet: Sequence[str], value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between each facet's min and max; the max falls in the last bin.
    No facet: one range for all rows."""
    facet = list(facet)
    base = df.select(*facet, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    rng = base.groupBy(*facet).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    j = _with_stats(base, rng, facet)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, 0).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return (j.withColumn("bin", b).groupBy(*facet, "bin")
             .agg(F.count(F.lit(1)).alias("cnt"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi")))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, one aggregation."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return row.select(F.expr(f"stack({len(pairs)}, {stack}) as (col_a, col_b, corr)"))


def trend_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` (slope, intercept, r2)."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_r2(F.col(y), F.col(x)).alias("r2"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))


def pivot_mean_count(df: DataFrame, row: str, col: str, target: str, ticks: Sequence[str] | None = None,
                     facet: Sequence[str] = ()) -> DataFrame:
    """Cell mean and cell count of ``target`` over ``row x col``; empty cells -> 0.

    With ``ticks`` the column set is fixed (no extra job to find the values).
    """
    g = _with_keys(df, (*facet, row, col)).groupBy(*facet, row).pivot(col, list(ticks) if ticks is not None else None)
    out = g.agg(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("count"))
    return out.na.fill(0, [c for c in out.columns if c not in (*facet, row)])


def pivot_count(df: DataFrame, row: str, col: str, ticks: Sequence[str] | None = None,
                facet: Sequence[str] = ()) -> DataFrame:
    """``size().pivot`` -- row counts per cell, empty -> 0."""
    out = _with_keys(df, (*facet, row, col)).groupBy(*facet, row).pivot(col, list(ticks) if ticks is not None else None).count()
    return out.na.fill(0, [c for c in out.columns if c not in (*facet, row)])


def vocabulary_sizes(df: DataFrame, cols: Sequence[str], multivalent: Sequence[str] = (),
                     outlier: str | None = "") -> DataFrame:
    """Distinct labels per categorical column (arrays counted by element),
    null and the outlier excluded; one stacked pass, long form ``(feature, n_unique)``."""
    def pairs(c: str) -> Column:
        values = F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>")) if c in multivalent else F.array(F.col(c).cast("string"))
        return F.transform(values, lambda v: F.struct(F.lit(c).alias("feature"), v.alias("label")))

    # one read of ``df`` for all columns; only distinct labels are moved
    stacked = df.select(F.explode(F.flatten(F.array(*[pairs(c) for c in [*cols, *multivalent]]))).alias("_p")).select("_p.feature", "_p.label")
    stacked = stacked.where(F.col("label").isNotNull())
    if outlier is not None:
        stacked = stacked.where(F.col("label") != F.lit(outlier))
    return stacked.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))


def numeric_tick_order(df: DataFrame, col: str, name: str = "tick") -> DataFrame:
    """Order string codes numerically ('2' before '10'); non-numbers last, by text."""
    from featurelane.operators.ordered import number_within
    return number_within(df, [], [F.col(col).try_cast("bigint").asc_nulls_last(), F.col(col)], name)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of a log (``unique``), e.g. the base list of J5."""
    return df.select(*keys).distinct()


def longest_elements(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The ``k`` longest elements of a multivalent column (ties by text)."""
    el = df.select(F.explode_outer(F.col(col)).alias("val")).where(F.col("val").isNotNull())
    return top_k(el.withColumn("n_chars", F.length("val")), [F.col("n_chars").desc(), F.col("val")], k)


def union_series(history: DataFrame, predictions: DataFrame, key: str, order: Sequence[str],
                 actual: str = "actual", pred: str = "pred") -> DataFrame:
    """History rows (no prediction) and predicted rows unioned, one
    position per key in time order; ``is_history`` is the null test on ``pred``."""
    from featurelane.operators.ordered import number_within
    h = history.withColumn(pred, F.lit(None).cast("double"))
    series = h.unionByName(predictions.select(*h.columns))
    return number_within(series, [key], list(order), "pos").withColumn("is_history", F.col(pred).isNull())
