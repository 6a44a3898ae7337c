"""Missing values, range repair, projection and predicates (N*, P*).

Fitted statistics (medians) are computed exactly and distributed -- see
:func:`featurelane.operators.ordered.exact_quantiles` -- and then applied as
literals, the way ``pyspark.ml.feature.Imputer`` applies its surrogates: the
fitted state is a handful of scalars, never a table that grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.operators.ordered import exact_quantiles


def column_quantiles(df: DataFrame, cols: Sequence[str], prob: float = 0.5,
                     where: dict[str, Column] | None = None) -> dict[str, float | None]:
    """Exact quantile of each column, all columns in one distributed pass.

    Columns are stacked to ``(name, value)`` and numbered per name, so the work
    is one shuffle whatever the number of columns.  ``where`` restricts the rows
    counted for a column (e.g. the in-range ages of N3).
    """
    where = where or {}
    exprs = []
    for c in cols:
        v = F.col(c).cast("double")
        if c in where:
            v = F.when(where[c], v)
        exprs.append(F.struct(F.lit(c).alias("_c"), v.alias("_x")))
    stacked = df.select(F.explode(F.array(*exprs)).alias("_s")).select("_s._c", "_s._x")
    q = exact_quantiles(stacked, ["_c"], "_x", [prob], ["_q"])
    found = {r["_c"]: r["_q"] for r in q.collect()}  # one row per column
    return {c: found.get(c) for c in cols}


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact median of the column's non-null values."""
    med = column_quantiles(df, cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(med[c])).alias(c) if c in med and med[c] is not None
                       else F.col(c) for c in df.columns])


def range_median(df: DataFrame, col: str, lo: float, hi: float, out: str | None = None) -> DataFrame:
    """Values outside ``[lo, hi]`` (and nulls) -> median of the in-range values."""
    ok = F.col(col).between(lo, hi)
    med = column_quantiles(df, [col], where={col: ok})[col]
    return df.withColumn(out or col, F.when(ok, F.col(col)).otherwise(F.lit(med)))


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Schema-driven fill.  A value of ``'median'`` means the fitted median;
    lists become array literals; other values are constants."""
    med_cols = [c for c, v in defaults.items() if isinstance(v, str) and v == "median"]
    med = column_quantiles(df, med_cols) if med_cols else {}
    out = df
    for c, v in defaults.items():
        if c in med:
            fill = F.lit(med[c])
        elif isinstance(v, (list, tuple)):
            fill = F.array(*[F.lit(x) for x in v])
        else:
            fill = F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), fill.cast(df.schema[c].dataType)))
    return out


def missing_fraction(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of rows whose value is null or ''."""
    return df.agg(*[F.avg((F.col(c).isNull() | (F.col(c).cast("string") == "")).cast("int")).alias(c)
                    for c in cols])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping (e.g. CamelCase -> snake_case)."""
    return df.withColumnsRenamed(mapping)


def camel_to_snake(name: str) -> str:
    """Rename rule used to build P1 maps: ``CompetitionOpenSinceMonth`` ->
    ``competition_open_since_month``; digits stay glued to the next word
    (``Promo2SinceWeek`` -> ``promo2since_week``)."""
    out = []
    for i, ch in enumerate(name):
        if ch.isupper() and i:
            prev = name[i - 1]
            nxt = name[i + 1] if i + 1 < len(name) else ""
            if prev.islower() or (prev.isupper() and nxt.islower()):
                out.append("_")
        out.append(ch.lower())
    return "".join(out)


def project(df: DataFrame, header: Sequence[str], raw_keys: dict[str, str] | None = None) -> DataFrame:
    """Ordered projection to a declared header, optional raw key copies first."""
    raw_keys = raw_keys or {}
    return df.select(*[F.col(src).alias(dst) for dst, src in raw_keys.items()], *header)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns (absent names are ignored)."""
    return df.drop(*cols)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter for a sub-analysis (one gender, one language, one target)."""
    return df.where(F.col(col) == F.lit(value))


def feature_columns(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """The feature columns of a prepared table -- everything but the label
    and the excluded keys.  Features and label stay in one DataFrame (rows are
    never split apart and re-aligned)."""
    return [c for c in df.columns if c != label and c not in set(exclude)]


def sort_within_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows sorted by key, then by date within the key.  A global sort is
    range-partitioned on the full sort key, so a hot key spreads over tasks."""
    return df.orderBy(*keys, *order)
