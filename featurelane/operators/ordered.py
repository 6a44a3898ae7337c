"""Order-dependent primitives that stay balanced under key skew.

``row_number() over (partition by k order by o)`` puts every row of a key into
one task.  When one key may hold a third of all rows that task is the whole job.
The primitives here range-partition on ``(k, o)`` instead, so a hot key's rows
are cut into many ordered slices (Spark's range partitioner samples the
composite key), then number or sum each slice locally and add the totals of
the earlier slices of the same key.  Every step is a built-in aggregate, window
over a small per-slice table, or join; nothing collects a group.  This is the only
way, whatever the size: no counting job, no threshold, no window over everything.

Determinism: the slice id must be identical for the per-slice totals and for
the rows they are added back to.  Two reads of a range exchange are not
guaranteed to agree (Catalyst prunes the two branches differently, so the
exchange is not reused, and each copy samples its own range bounds).  The
sliced rows are therefore written once with a reliable ``checkpoint()`` into
the session's checkpoint folder, slice id and row id included as data; both
branches read those files.  The same write makes the result survive executor
loss.  Callers must give an order that is total within a key (add a unique
tie-breaker) when positions matter; for quantiles ties do not change values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.session import cut_lineage

# monotonically_increasing_id = (partition index << 33) + row index in partition
_ROW_BITS = 33


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in names]


def _range_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], extra: Sequence[str]):
    """Null-safe join of ``left`` to ``right`` on keys + extra columns.

    ``right``'s copies of the join columns are renamed so the result keeps
    ``left``'s columns unambiguous.
    """
    ren = {c: f"_r_{i}" for i, c in enumerate(list(keys) + list(extra))}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = [left[c].eqNullSafe(r[ren[c]]) for c in keys] + [left[c] == r[ren[c]] for c in extra]
    joined = left.join(r, cond, "inner")
    return joined.drop(*ren.values())


def _sliced(df: DataFrame, keys: list[str], order_cols: list[Column],
            num_partitions: int | None) -> DataFrame:
    """Range-slice on (keys, order), sort each slice, attach ``_mid``/``_blk``, checkpoint."""
    n = _range_parts(df, num_partitions)
    ranged = (df.repartitionByRange(n, *_cols(keys), *order_cols)
                .sortWithinPartitions(*_cols(keys), *order_cols))
    t = (ranged.withColumn("_mid", F.monotonically_increasing_id())
               .withColumn("_blk", F.shiftright(F.col("_mid"), _ROW_BITS)))
    return cut_lineage(t)


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based ``row_number() over (partition by keys order by order)``.

    Skew-safe: a key may be cut into any number of ordered slices.
    ``keys`` may be empty (global numbering).
    """
    keys = list(keys)
    t = _sliced(df, keys, _cols(order), num_partitions)
    blocks = t.groupBy("_blk", *keys).agg(F.min("_mid").alias("_first"),
                                          F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
    blocks = blocks.select("_blk", *keys, "_first", "_before")
    out = _key_join(t, blocks, keys, ["_blk"])
    out = out.withColumn(name, (F.col("_mid") - F.col("_first") + 1 + F.col("_before")).cast("long"))
    return out.drop("_mid", "_blk", "_first", "_before")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 values: dict[str, Column], num_partitions: int | None = None) -> DataFrame:
    """Add cumulative sums (rows unbounded preceding .. current) of ``values``.

    Same slicing as :func:`number_within`; the local running sum is a window over
    ``(slice, key)``, which is balanced because a hot key is split into slices.
    """
    keys = list(keys)
    order_cols = _cols(order)
    base = df
    for name, expr in values.items():
        base = base.withColumn(f"_v_{name}", expr)
    t = _sliced(base, keys, order_cols, num_partitions)
    local = (Window.partitionBy("_blk", *keys).orderBy("_mid")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for name in values:
        t = t.withColumn(name, F.sum(f"_v_{name}").over(local))
    blocks = t.groupBy("_blk", *keys).agg(*[F.sum(f"_v_{nm}").alias(f"_b_{nm}") for nm in values])
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    for nm in values:
        blocks = blocks.withColumn(f"_p_{nm}", F.coalesce(F.sum(f"_b_{nm}").over(earlier), F.lit(0)))
    blocks = blocks.select("_blk", *keys, *[f"_p_{nm}" for nm in values])
    out = _key_join(t, blocks, keys, ["_blk"])
    for nm in values:
        out = out.withColumn(nm, F.col(nm) + F.col(f"_p_{nm}"))
    return out.drop("_mid", "_blk", *[f"_v_{nm}" for nm in values], *[f"_p_{nm}" for nm in values])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``).

    One row per key group with one column per probability.  Nulls are skipped.
    Unlike ``percentile``/``median`` no task ever holds a group's values: the
    values are sliced in order, the slices' totals say in which slice and at which
    row the two neighbours of each cut are, and only those rows are picked.
    """
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    vcol = value if isinstance(value, Column) else F.col(value)
    base = df.select(*keys, vcol.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    t = _sliced(base, keys, [F.col("_v")], num_partitions)
    blocks = t.groupBy("_blk", *keys).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"_before": F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)), "_n": F.sum("_cnt").over(group)})
    wanted = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for side, at in (("a", F.floor(h)), ("b", F.ceil(h))):
            wanted.append(F.struct(F.lit(f"{side}{i}").alias("_cut"), at.cast("long").alias("_at"), (h - F.floor(h)).alias("_fr")))
    cuts = blocks.select(*keys, "_first", "_before", "_cnt", F.explode(F.array(*wanted)).alias("_w")).select(
        *keys, (F.col("_first") + F.col("_w._at") - F.col("_before")).alias("_row"), "_w._cut", "_w._fr",
        F.col("_w._at").between(F.col("_before"), F.col("_before") + F.col("_cnt") - 1).alias("_here")).where("_here")
    picked = cuts.join(t.select("_mid", "_v"), F.col("_row") == F.col("_mid"))
    aggs = []
    for i, _ in enumerate(probs):
        aggs += [F.max(F.when(F.col("_cut") == f"{side}{i}", F.col(of))).alias(f"_{name}{i}") for side, of, name in
                 (("a", "_v", "a"), ("b", "_v", "b"), ("a", "_fr", "f"))]
    res = picked.groupBy(*keys).agg(*aggs)
    out = res.select(*keys, *[(F.col(f"_a{i}") + F.col(f"_f{i}") * (F.col(f"_b{i}") - F.col(f"_a{i}"))).alias(nm)
                              for i, nm in enumerate(names)])
    return out


def approx_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column, probs: Sequence[float],
                     names: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """Opt-in approximate quantiles (``percentile_approx``: a mergeable sketch per
    group, relative rank error about ``1 / accuracy``), one pass, no sort."""
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    vcol = (value if isinstance(value, Column) else F.col(value)).cast("double")
    agg = df.groupBy(*keys).agg(F.percentile_approx(vcol, [float(p) for p in probs], accuracy).alias("_q"))
    return agg.select(*keys, *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])
