"""Array helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the promo interval lists and their month numbers.
MONTH_CODES = {"Jan": "1", "Feb": "2", "Mar": "3", "Apr": "4", "May": "5", "Jun": "6",
               "Jul": "7", "Aug": "8", "Sept": "9", "Oct": "10", "Nov": "11", "Dec": "12"}


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def array_len(col: str | Column) -> Column:
    """R2: element count (``['']`` counts 1)."""
    return F.size(_c(col))


def map_elements(col: str | Column, mapping: dict[str, str]) -> Column:
    """Value map of array elements; unknown -> null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.transform(_c(col), lambda e: F.try_element_at(m, e))


def interval_flag(flag: str | Column, month: str | Column, interval: str | Column,
                  mapping: dict[str, str] = MONTH_CODES) -> Column:
    """``'1'`` if ``flag == '1'`` and month (string) is in the mapped
    comma-separated interval list, else ``'0'``."""
    months = map_elements(F.split(_c(interval), ","), mapping)
    hit = F.coalesce(F.array_contains(months, _c(month).cast("string")), F.lit(False))
    return F.when((_c(flag) == "1") & hit, F.lit("1")).otherwise(F.lit("0"))


def elementwise_product(a: str | Column, b: str | Column) -> Column:
    """``zip_with(a, b, x * y)``."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def concat_vectors(cols: Sequence[str | Column]) -> Column:
    """Feature vector concatenation."""
    return F.concat(*[_c(c) for c in cols])


def pad_to(col: str | Column, length: str | Column, fill=0) -> Column:
    """W6 helper: append ``fill`` up to ``length`` elements."""
    c = _c(col)
    n = F.greatest(_c(length) - F.size(c), F.lit(0))
    return F.concat(c, F.array_repeat(F.lit(fill), n))
