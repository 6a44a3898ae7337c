"""Code decoding and bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def code_norm(col: str | Column) -> Column:
    """``str(int(float(x)))`` with ``try_cast``; null or unparsable -> ''."""
    return F.coalesce(_c(col).try_cast("double").try_cast("bigint").cast("string"), F.lit(""))


def code_parts(col: str | Column, spans: dict[str, tuple[int, int]]) -> list[Column]:
    """fixed-position substrings (1-based start, length); missing -> ''."""
    return [F.coalesce(F.substring(_c(col), s, n), F.lit("")).alias(name) for name, (s, n) in spans.items()]


def two_digit_year(col: str | Column, pivot: int = 18) -> Column:
    """``yy < pivot -> 2000 + yy`` else ``1900 + yy``; unparsable -> null."""
    yy = _c(col).try_cast("int")
    return F.when(yy < pivot, yy + 2000).when(yy.isNotNull(), yy + 1900)


def bucket_labels(col: str | Column, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """``np.digitize`` (left-closed bins) then label lookup.

    ``labels`` has ``len(bins) + 1`` entries: index ``i`` is the label of values
    with ``i`` bin edges <= value.  Null -> the label of index 0.
    """
    assert len(labels) == len(bins) + 1
    x = _c(col).cast("double")
    k = F.lit(0)
    for b in bins:
        k = k + F.when(x >= F.lit(float(b)), 1).otherwise(0)
    arr = F.array(*[F.lit(s) for s in labels])
    return F.element_at(arr, F.when(x.isNull(), 1).otherwise(k + 1))


def age_buckets() -> tuple[list[int], list[str]]:
    """The age bins and their labels (outside 6..80 -> '')."""
    bins = [6, 10, 20, 30, 40, 60, 80]
    labels = ["", "6-10", "10-20", "20-30", "30-40", "40-60", "60-80", ""]
    return bins, labels
