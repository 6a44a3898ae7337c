"""Per-entity history aggregates (weighted multivalent triples).

For an interaction log ``(entity, value, target)`` the history of an entity is
the list of distinct values it met, each with the row count and the mean
target, sorted by value.  Two shapes:

* long form ``(entity, pos, value, cnt, mean)`` -- no collection at all; ``pos``
  comes from the skew-safe :func:`number_within`.  This is what queries use.
* array form ``value_hist / value_count / value_mean`` aligned arrays -- the
  model-ready feature.  It collects the *pre-aggregated* distinct values of one
  entity into its own output row, which is the feature itself.

Reference semantics kept: null values form no group (pandas drops null keys);
a multivalent null becomes ``['']`` before unnesting and so does form a group;
entities of the base list without history get ``['']`` / ``[0.0]`` / ``[0.0]``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.operators.ordered import number_within


def unnest(df: DataFrame, col: str, keep: Sequence[str] | None = None, pos: str | None = None) -> DataFrame:
    """Flatten a multivalent column: one row per element; null array -> one '' row.

    Uses the ``_outer`` generator and drops the empty-array row afterwards:
    a plain ``explode`` makes Catalyst infer ``size(arr) > 0`` and push it
    into the scan, which evaluates an expensive array expression twice.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != col]
    arr = F.coalesce(F.col(col), F.array(F.lit("")))
    p = pos or "_upos"
    out = df.select(*keep, F.posexplode_outer(arr).alias(p, col)).where(F.col(p).isNotNull())
    if pos:
        return out.withColumn(pos, (F.col(pos) + 1).cast("long"))
    return out.drop(p)


def value_stats(log: DataFrame, entity: str | Sequence[str], value: str, target: str,
                stats: Sequence[str] = ("count", "mean")) -> DataFrame:
    """``groupBy(entity, value)`` count / mean of target; null values form no group.

    Map-side partial aggregation keeps this balanced under entity skew.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    aggs = []
    if "count" in stats:
        aggs.append(F.count(target).cast("double").alias("cnt"))
    if "mean" in stats:
        aggs.append(F.avg(target).alias("mean"))
    return log.where(F.col(value).isNotNull()).groupBy(*ents, value).agg(*aggs)


def history_long(log: DataFrame, entity: str | Sequence[str], value: str, target: str,
                 stats: Sequence[str] = ("count", "mean"), multivalent: bool = False) -> DataFrame:
    """Long-form history: ``(entity, pos, value, cnt[, mean])`` sorted by value."""
    ents = [entity] if isinstance(entity, str) else list(entity)
    if multivalent:
        log = unnest(log.select(*ents, value, target), value)
    agg = value_stats(log, ents, value, target, stats)
    return number_within(agg, ents, [F.col(value)], "pos")


def history_arrays(log: DataFrame, entity: str, value: str, target: str, prefix: str,
                   stats: Sequence[str] = ("count", "mean"), multivalent: bool = False) -> DataFrame:
    """Array form: ``{prefix}_hist``, ``{prefix}_count``, ``{prefix}_mean`` aligned by value.

    R3 (records -> columns): one sorted ``array<struct>`` per entity, then a
    field access per column (``_h.v``, ``_h.cnt`` ...) yields the aligned arrays.
    """
    if multivalent:
        log = unnest(log.select(entity, value, target), value)
    agg = value_stats(log, entity, value, target, stats)
    fields = [F.col(value).alias("v")] + [F.col(c) for c in ("cnt", "mean") if c in agg.columns]
    nested = agg.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_h"))
    cols = [F.col(entity), F.col("_h.v").alias(f"{prefix}_hist")]
    if "count" in stats:
        cols.append(F.col("_h.cnt").alias(f"{prefix}_count"))
    if "mean" in stats:
        cols.append(F.col("_h.mean").alias(f"{prefix}_mean"))
    return nested.select(*cols)


#: Rows of whole entities that are counted together.
TOGETHER = 1 << 15


def _bounded_matrix(log: DataFrame, entity: str, features: dict[str, Sequence[str]], target: str, prefix: str, multi: Sequence[str],
                    together: int) -> DataFrame:
    """``history_matrix`` of a log whose rows per entity are bounded: an entity's rows move once, as they are, and are counted where they meet."""
    def differ(c: pa.Array) -> np.ndarray:
        return pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False).astype(bool)

    def of(values: pa.Array, row: np.ndarray, e: np.ndarray, m: int, has: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        known = values.is_valid().to_numpy(zero_copy_only=False)
        d = values.drop_null().dictionary_encode()
        order = pc.sort_indices(d.dictionary).to_numpy()
        labels, rank, n = d.dictionary.take(pa.array(order)), np.empty(len(order), np.int64), max(1, len(order))
        rank[order] = np.arange(len(order))
        row = row[known]
        cell = e[row] * n + rank[d.indices.to_numpy()]
        if m * n <= 16 * len(cell):
            met = np.flatnonzero(np.bincount(cell, minlength=m * n))
            count, total = (np.bincount(cell, w[row], m * n)[met] for w in (has, t))
        else:
            met, cell = np.unique(cell, return_inverse=True)
            count, total = (np.bincount(cell, w[row], len(met)) for w in (has, t))
        return np.bincount(met // n, minlength=m), labels.take(pa.array(met % n)), count, total

    def histories(rows: pa.Table) -> pa.RecordBatch:
        names = rows.column(0).combine_chunks()
        new = np.concatenate(([True], differ(names)))
        e, m, at = np.cumsum(new) - 1, int(new.sum()), np.arange(len(new))
        has = rows.column(1).combine_chunks().is_valid().to_numpy(zero_copy_only=False).astype(np.float64)
        t = rows.column(1).combine_chunks().fill_null(0.0).to_numpy(zero_copy_only=False)
        out, sizes = [], np.zeros(m, np.int64)
        for k, (c, stats) in enumerate(features.items()):
            values, row = rows.column(k + 2).combine_chunks(), at
            if c in multi:
                row, values = np.repeat(at, values.value_lengths().to_numpy(zero_copy_only=False)), values.flatten()
            per, labels, count, total = of(values, row, e, m, has, t)
            sizes += per
            ends = pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32())
            found = {"count": pa.array(count, pa.float64()), "mean": pa.array(total / np.maximum(count, 1), mask=count == 0)}
            out += [pa.ListArray.from_arrays(ends, x) for x in [labels, *[found[s] for s in stats]]]
        return pa.RecordBatch.from_arrays([names.take(pa.array(np.flatnonzero(new))), *out], names=columns).filter(pa.array(sizes > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, least = [], 0, together
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= least:
                rows = pa.Table.from_batches(held).combine_chunks()
                starts = np.flatnonzero(differ(rows.column(0).combine_chunks())) + 1
                if len(starts):  # the last entity may go on
                    yield histories(rows.slice(0, int(starts[-1])))
                    rows = rows.slice(int(starts[-1])).combine_chunks()
                held, n = rows.to_batches(), rows.num_rows
                least = max(together, 2 * n)
        if n:
            yield histories(pa.Table.from_batches(held).combine_chunks())

    fields = [(f"{prefix}_{c}_{s}", "array<string>" if s == "hist" else "array<double>") for c, stats in features.items() for s in ["hist", *stats]]
    columns = [entity, *[n for n, _ in fields]]
    values = [F.coalesce(F.col(c).cast("array<string>"), F.array(F.lit(""))) if c in multi else F.col(c).cast("string") for c in features]
    rows = (log.where(F.col(entity).isNotNull()).select(entity, F.col(target).cast("double").alias("_t"), *[v.alias(f"_v{k}") for k, v in enumerate(values)])
            .repartition(entity).sortWithinPartitions(entity))
    return rows.mapInArrow(run, ", ".join([f"`{entity}` {log.schema[entity].dataType.simpleString()}", *[f"`{n}` {t}" for n, t in fields]]))


def history_matrix(log: DataFrame, entity: str, features: dict[str, Sequence[str]], target: str, prefix: str,
                   multi: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """A1-A3 and R3 for many features of one entity in one pass: ``{prefix}_{feature}_hist`` and its statistics.

    Every row becomes one ``(feature, value)`` row per feature, or per element of a multivalent one; one
    grouped aggregation gives count and mean of the target, a second gathers each feature's distinct values, sorted, in arrays.
    Null values form no group, a null array counts as ``['']``.  What is gathered is one entity's distinct values; ``bounded``: an entity has a
    bounded number of rows, so these are gathered instead of being unpivoted first.
    """
    if bounded:
        return _bounded_matrix(log, entity, features, target, prefix, multi, TOGETHER)

    def pair(c: str, v: Column) -> Column:
        return F.struct(F.lit(list(features).index(c)).alias("f"), v.cast("string").alias("v"))

    def elements(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c).cast("array<string>"), F.array(F.lit(""))), lambda v: pair(c, v))

    # plain columns in one array without a lambda, which is evaluated one object at a time
    pairs = [F.array(*[pair(c, F.col(c)) for c in features if c not in multi])] if any(c not in multi for c in features) else []
    pairs += [elements(c) for c in features if c in multi]
    long = log.where(F.col(entity).isNotNull()).select(entity, F.col(target).alias("_t"), F.explode(F.concat(*pairs)).alias("_p"))
    long = long.select(entity, "_t", "_p.f", "_p.v").where(F.col("v").isNotNull())
    agg = long.groupBy(entity, "f", "v").agg(F.count("_t").cast("double").alias("count"), F.avg("_t").alias("mean"))
    nested = agg.groupBy(entity).agg(*[F.sort_array(F.collect_list(F.when(F.col("f") == k, F.struct("v", "count", "mean")))).alias(f"_h{k}")
                                       for k, _ in enumerate(features)])
    out = [F.col(entity)]
    for k, (c, stats) in enumerate(features.items()):
        out += [F.col(f"_h{k}.v").alias(f"{prefix}_{c}_hist"), *[F.col(f"_h{k}.{s}").alias(f"{prefix}_{c}_{s}") for s in stats]]
    return nested.select(*out)


def polarity_arrays(log: DataFrame, entity: str, item: str, target: str, order: Sequence[str], prefix: str) -> DataFrame:
    """A4 as arrays: an entity's items with target 1 and with target 0 in log order, each with weights 1.0.

    Gathers an entity's rows: for logs whose rows per entity are bounded, as after the activity split.
    """
    out = [F.col(entity)]
    lists = []
    for way, flag in (("pos", 1), ("neg", 0)):
        row = F.struct(*[F.col(c) for c in order], F.col(item).cast("string").alias("_item"))
        lists.append(F.sort_array(F.collect_list(F.when(F.col(target) == flag, row))).alias(f"_{way}"))
        out += [F.col(f"_{way}._item").alias(f"{prefix}_{way}_query_hist"),
                F.transform(f"_{way}", lambda _: F.lit(1.0)).alias(f"{prefix}_{way}_query_count")]
    return log.where(F.col(entity).isNotNull()).groupBy(entity).agg(*lists).select(*out)


def fill_history_defaults(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null or empty arrays -> ``['']`` for ``*_hist``, ``[0.0]`` for counts/means."""
    out = df
    for c in columns:
        default = F.array(F.lit("")) if c.endswith("_hist") else F.array(F.lit(0.0))
        out = out.withColumn(c, F.when(F.col(c).isNull() | (F.size(F.col(c)) == 0), default).otherwise(F.col(c)))
    return out


def reindex_long(base: DataFrame, hist: DataFrame, entity: str | Sequence[str],
                 value: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """J5 + N4 in long form: every base entity appears; absent -> one default row.

    ``base`` carries the entity key(s) and any profile columns.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    defaults = defaults or {}
    out = base.join(hist, ents, "left")
    fills = {"pos": F.lit(1).cast("long"), value: F.lit(""), "cnt": F.lit(0.0), "mean": F.lit(0.0)}
    fills.update(defaults)
    for c, d in fills.items():
        if c in hist.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), d))
    return out


def polarity_items(log: DataFrame, entity: str, item: str, target: str,
                   order: Sequence[str | Column]) -> DataFrame:
    """A4: positive / negative item lists per entity in log order, duplicates kept.

    Long form ``(entity, polarity, pos, item, weight=1.0)``; ``order`` must be a
    total order (e.g. ``ts, event_id``).
    """
    # a null target is neither: only 1 and 0 are selected
    tagged = log.where(F.col(target).isin(0, 1) & F.col(entity).isNotNull()).select(entity, item, *[c for c in order if isinstance(c, str)],
                        F.when(F.col(target) == 1, F.lit("pos")).otherwise(F.lit("neg")).alias("polarity"))
    numbered = number_within(tagged, [entity, "polarity"], order, "pos")
    return numbered.select(entity, "polarity", "pos", item, F.lit(1.0).alias("weight"))


def polarity_defaults(base: DataFrame, lists: DataFrame, entity: str, item: str) -> DataFrame:
    """Entities without positive (or negative) rows get one ``('', 0.0)`` row."""
    grid = base.select(entity, F.explode(F.array(F.lit("pos"), F.lit("neg"))).alias("polarity"))
    out = grid.join(lists, [entity, "polarity"], "left")
    return out.select(entity, "polarity", F.coalesce("pos", F.lit(1).cast("long")).alias("pos"),
                      F.coalesce(item, F.lit("")).alias(item),
                      F.coalesce("weight", F.lit(0.0)).alias("weight"))


def entity_popularity(log: DataFrame, entity: str, target: str, prefix: str) -> DataFrame:
    """A5: ``{prefix}_clicks`` = count, ``{prefix}_pplrty`` = mean target."""
    return log.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(target).cast("double").alias(f"{prefix}_clicks"),
                                   F.avg(target).alias(f"{prefix}_pplrty"))


def unpivot_history(log: DataFrame, entity: str, features: Sequence[str], target: str) -> DataFrame:
    """Single-pass history over many univariate features.

    ``stack`` turns each row into ``(entity, feature, value, target)`` rows, so
    one aggregation replaces one scan per feature; output is long form with
    ``pos`` per ``(entity, feature)``.
    """
    pairs = ", ".join(f"'{f}', cast(`{f}` as string)" for f in features)
    stacked = log.select(entity, target, F.expr(f"stack({len(features)}, {pairs}) as (feature, value)"))
    agg = value_stats(stacked, [entity, "feature"], "value", target)
    return number_within(agg, [entity, "feature"], [F.col("value")], "pos")
