"""Fitted encoders and scalers.

A vocabulary is a DataFrame ``(label, freq, idx)``; ids start at 1, unknown /
null / outlier encode to 0 and decode to null.  Vocabularies are joined, never
collected: their size grows with the data, so Spark (AQE, from measured sizes)
decides between a broadcast and a shuffle join.  Scaler statistics are a few
scalars per column and are applied as literals, like spark.ml models.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.operators.clean import column_quantiles
from featurelane.operators.ordered import number_within


def _labels(df: DataFrame, col: str | Column, multivalent: bool, outlier: str | None) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    if multivalent:
        # _outer + null filter: no inferred size() filter re-evaluating ``c`` in the scan
        lab = df.select(F.explode_outer(c).alias("label"))
    else:
        lab = df.select(c.alias("label"))
    lab = lab.select(F.col("label").cast("string").alias("label")).where(F.col("label").isNotNull())
    if outlier is not None:
        lab = lab.where(F.col("label") != F.lit(outlier))
    return lab


def label_counts(df: DataFrame, col: str | Column, multivalent: bool = False, outlier: str | None = "") -> DataFrame:
    """Occurrences of each label (every element for multivalent columns)."""
    return _labels(df, col, multivalent, outlier).groupBy("label").agg(F.count(F.lit(1)).alias("freq"))


def frequency_vocab(df: DataFrame, col: str | Column, multivalent: bool = False, outlier: str | None = "",
                    min_freq: int = 0) -> DataFrame:
    """Ids by descending frequency, ties by label, from 1."""
    return rank_counts(label_counts(df, col, multivalent, outlier), min_freq)


def rank_counts(counts: DataFrame, min_freq: int = 0) -> DataFrame:
    """Rank a ``(label, freq)`` table into a vocabulary (used by fit and partial_fit)."""
    kept = counts.where(F.col("freq") >= min_freq)
    return number_within(kept, [], [F.col("freq").desc(), F.col("label")], "idx")


def merge_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """E4 partial_fit: accumulate counts; the threshold is applied on ranking only."""
    return (old.select("label", "freq").unionByName(new.select("label", "freq"))
               .groupBy("label").agg(F.sum("freq").alias("freq")))


def sorted_vocab(df: DataFrame, col: str | Column, multivalent: bool = False, outlier: str | None = "") -> DataFrame:
    """Ids 1..n by sorted label (outlier excluded)."""
    counts = label_counts(df, col, multivalent, outlier)
    return number_within(counts, [], [F.col("label")], "idx")


def vocabulary_table(df: DataFrame, columns: Sequence[str], multi: Sequence[str] = (), outlier: str = "",
                     min_freq: int = 0, together: Sequence[Sequence[str]] = ()) -> DataFrame:
    """E2 / E3 for many columns in one pass: ``(column, label, freq, idx)``, numbered within each column.

    ``together``: groups of columns that take few combinations of values, as an entity's and its attributes'.  The rows of each
    combination are counted first, so its labels are looked at once and not in each row; the counts are the same.
    """
    def pair(c: str, v: Column) -> Column:
        return F.struct(F.lit(c).alias("column"), v.cast("string").alias("label"))

    def elements(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>")), lambda v: pair(c, v))

    def counted(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        plain, lists = [c for c in names if c not in multi], [c for c in names if c in multi]
        pairs = [F.array(*[pair(c, F.col(c)) for c in plain])] if plain else []
        pairs += [elements(c) for c in lists]
        long = rows.select("_n", F.explode(F.concat(*pairs)).alias("_p")).select("_n", "_p.column", "_p.label")
        return long.where(F.col("label").isNotNull() & (F.col("label") != outlier)).groupBy("column", "label").agg(F.sum("_n").alias("freq"))

    wanted = [*columns, *multi]
    groups = [[c for c in g if c in wanted] for g in together]
    alone = [c for c in wanted if not any(c in g for g in groups)]
    parts = [counted(df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")), g) for g in groups if g]
    parts += [counted(df.withColumn("_n", F.lit(1).cast("long")), alone)] if alone else []
    counts = parts[0]
    for x in parts[1:]:
        counts = counts.unionByName(x)
    return number_within(counts.where(F.col("freq") >= min_freq), ["column"], [F.col("freq").desc(), F.col("label")], "idx")


#: Vocabularies of at most so many labels go to the tasks whole; longer ones are joined.
FEW_LABELS = 10_000


def _encode_few(df: DataFrame, vocabs: dict[str, str], table: DataFrame) -> DataFrame:
    """``encode_columns`` for short vocabularies, without moving a row."""
    labels: dict[str, tuple[list, list]] = {v: ([], []) for v in vocabs.values()}
    for row in table.where(F.col("column").isin(*labels)).select("column", "label", "idx").collect() if labels else []:
        labels[row["column"]][0].append(row["label"])
        labels[row["column"]][1].append(row["idx"])
    arrays = {c for c, t in df.dtypes if t.startswith("array") and c in vocabs}

    def lookup(c: str) -> Column:
        names, ids = labels[vocabs[c]]

        def code(values: pa.Array) -> pa.Array:
            at = pc.index_in(values, value_set=pa.array(names, pa.string()))
            return pc.fill_null(pc.take(pa.array(ids, pa.int32()), at), 0)

        if c in arrays:
            @F.arrow_udf("array<int>")
            def coded(values: pa.Array) -> pa.Array:
                ends = np.concatenate(([0], np.cumsum(values.value_lengths().to_numpy(False))))
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), code(values.flatten().cast(pa.string())))
            return coded(F.coalesce(F.col(c).cast("array<string>"), F.array(F.lit(""))))

        @F.arrow_udf("int")
        def coded(values: pa.Array) -> pa.Array:
            return code(values.cast(pa.string()))
        return coded(F.col(c).cast("string"))

    return df.withColumns({c: lookup(c) for c in vocabs}) if vocabs else df


def encode_columns(df: DataFrame, key: str, vocabs: dict[str, str], table: DataFrame) -> DataFrame:
    """Label columns (plain or arrays) as ids, each by the named vocabulary of a ``vocabulary_table``.

    Columns whose vocabulary has at most ``FEW_LABELS`` labels are looked up where their rows lie.  The others go in one pass:
    (key, column, position, label) joins the table once and is gathered per key, so order and
    length stay.  Unknown and null labels are 0, a null array is ``[0]``, an empty one stays empty.  ``key`` names a row; what is gathered is a row's own elements
    (of rows that share a key, the elements of all; where there are such rows all columns are joined).
    """
    sizes = {} if not df.groupBy(key).count().where("count > 1").isEmpty() else dict(table.where(F.col("column").isin(*set(vocabs.values()))).groupBy("column").count().collect())  # one row per column
    few = {c: v for c, v in vocabs.items() if v in sizes and sizes[v] <= FEW_LABELS}
    df = _encode_few(df, few, table)
    vocabs = {c: v for c, v in vocabs.items() if c not in few}
    if not vocabs:
        return df
    arrays = {c for c, t in df.dtypes if t.startswith("array") and c in vocabs}

    def cell_of(c: str, k: Column, v: Column) -> Column:
        return F.struct(F.lit(list(vocabs).index(c)).alias("_c"), F.lit(vocabs[c]).alias("column"), k.alias("_k"), v.cast("string").alias("label"))

    def elements(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c).cast("array<string>"), F.array(F.lit(""))), lambda v, k: cell_of(c, k, v))

    plain = [c for c in vocabs if c not in arrays]
    cells = [F.array(*[cell_of(c, F.lit(0), F.col(c)) for c in plain])] if plain else []
    cells += [elements(c) for c in vocabs if c in arrays]
    long = df.select(F.col(key).alias("_key"), F.explode(F.concat(*cells)).alias("_p")).select("_key", "_p.*")
    found = long.join(table.select("column", "label", "idx"), ["column", "label"], "left")
    cell = F.struct("_k", F.coalesce("idx", F.lit(0)).cast("int").alias("_i"))
    wide = found.groupBy("_key").agg(*[F.sort_array(F.collect_list(F.when(F.col("_c") == n, cell))).alias(f"_e{n}") for n, _ in enumerate(vocabs)])
    out = df.join(wide, df[key].eqNullSafe(wide["_key"]), "left")
    done = {c: F.col(f"_e{n}._i") if c in arrays else F.coalesce(F.try_element_at(F.col(f"_e{n}._i"), F.lit(1)), F.lit(0)) for n, c in enumerate(vocabs)}
    return out.select(*[done[c].alias(c) if c in done else F.col(c) for c in df.columns])


def encode(df: DataFrame, col: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """Label -> id (unknown, null, outlier -> 0)."""
    out = out or col
    v = vocab.select(F.col("label").alias("_lab"), F.col("idx").alias("_idx"))
    j = df.join(v, F.col(col).cast("string") == F.col("_lab"), "left")
    return j.withColumn(out, F.coalesce(F.col("_idx"), F.lit(0)).cast("int")).drop("_lab", "_idx")


def decode(df: DataFrame, col: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """E5: id -> label, unknown -> null."""
    out = out or col
    v = vocab.select(F.col("label").alias("_lab"), F.col("idx").alias("_idx"))
    j = df.join(v, F.col(col) == F.col("_idx"), "left")
    return j.withColumn(out, F.col("_lab")).drop("_lab", "_idx")


def encode_array_long(df: DataFrame, row_key: Sequence[str], col: str, vocab: DataFrame,
                      out: str = "idx") -> DataFrame:
    """R6, scale path: ``posexplode`` -> join vocabulary -> one row per element.

    Keeps order (``pos``, 1-based) and length; unknown elements -> 0.
    """
    ex = df.select(*row_key, F.posexplode_outer(F.coalesce(F.col(col), F.array(F.lit("")))).alias("pos", "label"))
    ex = ex.where(F.col("pos").isNotNull()).withColumn("pos", (F.col("pos") + 1).cast("long"))
    v = vocab.select(F.col("label").alias("_lab"), F.col("idx").alias("_idx"))
    j = ex.join(v, F.col("label") == F.col("_lab"), "left")
    return j.select(*row_key, "pos", F.col("label").alias(col), F.coalesce("_idx", F.lit(0)).cast("int").alias(out))


def encode_array(df: DataFrame, row_key: Sequence[str], col: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """R6 nested: re-collect the encoded elements of each row in position order."""
    return encode_arrays(df, row_key, {col: vocab}, {col: out or col})


def encode_arrays(df: DataFrame, row_key: Sequence[str], vocabs: dict[str, DataFrame],
                  out_names: dict[str, str] | None = None) -> DataFrame:
    """R6 / E16 for many array columns in one pass.

    All array columns are stacked to ``(key, column, pos, label)``, joined once
    against the union of their vocabularies, re-collected per ``(key, column)``
    (one row's own elements) and pivoted back over the fixed column list; the
    result is joined to ``df`` once.  ``row_key`` must identify a row.
    """
    keys = list(row_key)
    cols = list(vocabs)
    out_names = out_names or {}
    # one vocabulary table; each column's vocabulary is tagged with the column name
    voc = None
    for c, v in vocabs.items():
        tagged = v.select(F.lit(c).alias("_col"), F.col("label").alias("_lab"), F.col("idx").alias("_idx"))
        voc = tagged if voc is None else voc.unionByName(tagged)
    arrays = F.array(*[F.struct(F.lit(c).alias("_col"),
                                F.coalesce(F.col(c).cast("array<string>"), F.array(F.lit(""))).alias("_a"))
                       for c in cols])
    long = (df.select(*keys, F.explode(arrays).alias("_s"))
              .select(*keys, "_s._col", F.posexplode_outer("_s._a").alias("_pos", "_lab"))
              .where(F.col("_pos").isNotNull()))
    j = long.join(voc, ["_col", "_lab"], "left").withColumn("_idx", F.coalesce("_idx", F.lit(0)).cast("int"))
    nested = j.groupBy(*keys, "_col").agg(F.sort_array(F.collect_list(F.struct("_pos", "_idx"))).alias("_l"))
    nested = nested.withColumn("_ids", F.col("_l._idx"))
    wide = nested.groupBy(*keys).pivot("_col", cols).agg(F.first("_ids"))
    wide = wide.select(*keys, *[F.col(f"`{c}`").alias(f"_enc_{c}") for c in cols])
    res = df.join(wide, keys, "left")
    for c in cols:
        res = res.withColumn(out_names.get(c, c), F.col(f"_enc_{c}"))
    return res.drop(*[f"_enc_{c}" for c in cols if out_names.get(c, c) != f"_enc_{c}"])


# ------------------------------------------------------------------ scalers

@dataclass
class ScalerModel:
    """Per-column ``mean``, ``std`` (0 -> 1) and ``median``; transform fills the
    median then standardises; inverse maps back."""

    stats: dict[str, dict[str, float]] = field(default_factory=dict)
    fill_median: bool = True

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
        out = df
        for c in cols or list(self.stats):
            s = self.stats[c]
            x = F.col(c).cast("double")
            if self.fill_median and s["median"] is not None:
                x = F.coalesce(x, F.lit(s["median"]))
            out = out.withColumn(c + suffix, (x - F.lit(s["mean"])) / F.lit(s["std"]))
        return out

    def inverse(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        out = df
        for c in cols or list(self.stats):
            s = self.stats[c]
            out = out.withColumn(c, F.col(c) * F.lit(s["std"]) + F.lit(s["mean"]))
        return out


def fit_scaler(df: DataFrame, cols: Sequence[str], ddof: int = 0, fill_median: bool = True) -> ScalerModel:
    """E6 (``ddof=0``, population std) / E7 (``ddof=1``, sample std), on non-null values."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[std(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    med = column_quantiles(df, cols)
    stats = {}
    for i, c in enumerate(cols):
        s = row[f"s_{i}"]
        stats[c] = {"mean": row[f"m_{i}"], "std": 1.0 if not s else s, "median": med[c]}
    return ScalerModel(stats, fill_median)


# --------------------------------------------------------- hashing and crosses

def _md5_bucket(key: Column, buckets: int) -> Column:
    """The first 60 bits of the MD5, modulo the number of buckets: the same in every engine."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def hash_bucket(col: str | Column, buckets: int) -> Column:
    """Stable hash bucket in ``[0, buckets)``; null as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return _md5_bucket(F.coalesce(c.cast("string"), F.lit("")), buckets)


def hashed_cross(cols: Sequence[str | Column], buckets: int) -> Column:
    """Feature cross of several columns hashed into ``buckets``; null as the empty text.

    Each value is written with its length, so that ('a', 'bc') and ('ab', 'c') are different keys.
    """
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return _md5_bucket(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), buckets)


def one_hot_fixed(col: str | Column, vocabulary: Sequence[str], prefix: str) -> list[Column]:
    """Indicator columns for a fixed vocabulary; unknown -> all zeros."""
    c = F.col(col) if isinstance(col, str) else col
    return [(c == F.lit(v)).cast("int").alias(f"{prefix}_{i}") for i, v in enumerate(vocabulary)]


def identity_bucket(col: str | Column, n: int) -> Column:
    """Integer category in ``[0, n)``; anything else -> null."""
    c = (F.col(col) if isinstance(col, str) else col)
    v = c.try_cast("int")
    return F.when((v >= 0) & (v < n), v)
