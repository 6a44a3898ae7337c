"""Token counts of sections: offset-mapped attribution.

Each document is encoded once, whole, so that no token is changed by where a section
begins.  A byte-level token stands for known bytes, so the running sum of the
tokens' byte lengths is the offset map, exact to the byte.  The token spans are then
interval-joined to the document's sections (both sorted: two binary searches a token),
and a token that crosses a boundary is allocated by an explicit rule:

* ``majority``: to the section that holds most of its bytes; ties go to the earlier one;
* ``start``: to the section that holds its first byte that any section holds;
* ``share``: split in proportion to the bytes (``n_tokens`` is then a fraction).

Sections are half-open ranges of characters.  If two overlap, the one that starts first (then ends
first, then has the smaller id) keeps the common part.  Tokens that touch no section are counted
in a row with section_id null, so a document's rows always sum to its tokens.

Results by case: a null or empty text has one row per section, or one row with section 0 by
lines, of 0 tokens; sections beyond the text's end are cut there, null borders make an empty
section; sections of unknown documents are left out; a document without sections has only the
row with section_id null; rows of ``docs`` that repeat are counted each.
The join to given sections is by document; a document's sections are collected into one row,
which the document's own length bounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featurelane.llm.tokens import BYTE_BPE, encoder, read_vocabulary
from featurelane.llm.words import spans, text_bytes

RULES = ("majority", "start", "share")
_OUT = "section_id long, start long, stop long, n_tokens double, n_crossing long, doc_tokens long"


def line_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the lines, each with its newline; an empty text is one empty line."""
    ends = np.flatnonzero(data == 10) + 1
    if not len(data) or not len(ends) or ends[-1] < len(data):
        ends = np.append(ends, len(data))
    return np.concatenate(([0], ends[:-1])), ends


def allocate(token_stop: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(tokens, crossing tokens) of sections [lo, hi) that are sorted and apart, and the tokens outside all."""
    n = len(lo)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    start = np.concatenate(([0], token_stop[:-1])).astype(np.int64)
    first = np.searchsorted(hi, start, "right")
    last = np.searchsorted(lo, token_stop, "left") - 1
    outside = float((last < first).sum())
    one = first == last
    covered = one.copy()
    covered[one] = (lo[first[one]] <= start[one]) & (token_stop[one] <= hi[first[one]])
    np.add.at(counts, first[covered], 1.0)
    cross = np.flatnonzero((last >= first) & ~covered)
    for t in cross:
        ids = np.arange(first[t], last[t] + 1)
        part = np.minimum(hi[ids], token_stop[t]) - np.maximum(lo[ids], start[t])
        ids, part = ids[part > 0], part[part > 0]
        if not len(ids):
            outside += 1
            continue
        crossing[ids] += 1
        if rule == "share":
            counts[ids] += part / part.sum()
        else:
            counts[ids[0] if rule == "start" else ids[np.argmax(part)]] += 1.0
    return counts, crossing, outside


def _given(sections: list[dict] | None, chars: np.ndarray, n_bytes: int):
    """Ids, character ranges and byte ranges of given sections, sorted and made apart."""
    n = len(chars)
    rows = sorted((s["start"] if s["start"] is not None else 0, s["stop"] if s["stop"] is not None else (s["start"] or 0),
                   s["section_id"] if s["section_id"] is not None else -1) for s in sections or ())
    lo, hi, reached = [], [], 0
    for a, b, _ in rows:
        a = min(max(a, 0, reached), n)
        b = min(max(a, b), n)
        lo.append(a)
        hi.append(b)
        reached = max(reached, b)
    at = np.append(chars, n_bytes)
    return ([r[2] for r in rows], np.array(lo, np.int64), np.array(hi, np.int64),
            at[np.array(lo, np.int64)], at[np.array(hi, np.int64)])


def attribute_tokens(docs: DataFrame, sections: DataFrame | None = None, rule: str = "majority",
                     vocabulary: str = BYTE_BPE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document and section: section_id, start, stop (characters), n_tokens, n_crossing, doc_tokens.

    ``sections`` has the key, section_id, start and stop; without it the sections are the lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # fixed size
    src = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    if sections is not None:
        per = (sections.groupBy(F.col(f"`{key}`").alias("_of"))
               .agg(F.collect_list(F.struct(F.col("section_id").cast("long").alias("section_id"),
                                            F.col("start").cast("long").alias("start"),
                                            F.col("stop").cast("long").alias("stop"))).alias("_sections")))
        src = src.join(per, src["_key"] == per["_of"], "left").select("_key", "_text", "_sections")
    by_line = sections is None
    out = StructType([src.schema["_key"], *StructType.fromDDL(_OUT)])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in spans(off):
                rows, ids, starts, stops, counts, crosses, totals = [], [], [], [], [], [], []
                for r in range(i, j):
                    raw = data[off[r]:off[r + 1]]
                    token_stop = np.cumsum(enc.lengths[enc.ids(raw)])
                    chars = np.flatnonzero((raw & 0xC0) != 0x80)
                    if by_line:
                        lo, hi = line_borders(raw)
                        given = range(len(lo))
                        c_lo, c_hi = np.searchsorted(chars, lo), np.searchsorted(chars, hi)
                    else:
                        given, c_lo, c_hi, lo, hi = _given(batch.column(2)[r].as_py(), chars, len(raw))
                    full = np.flatnonzero(hi > lo)
                    n, crossing = np.zeros(len(lo)), np.zeros(len(lo), np.int64)
                    n[full], crossing[full], outside = allocate(token_stop, lo[full], hi[full], rule)
                    k = len(lo)
                    rows += [r] * k
                    ids += list(given)
                    starts += c_lo.tolist()
                    stops += c_hi.tolist()
                    counts += n.tolist()
                    crosses += crossing.tolist()
                    totals += [len(token_stop)] * k
                    if outside or not k:
                        rows.append(r)
                        ids.append(None)
                        starts.append(None)
                        stops.append(None)
                        counts.append(outside)
                        crosses.append(0)
                        totals.append(len(token_stop))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in (ids, starts, stops)),
                     pa.array(counts, pa.float64()), pa.array(crosses, pa.int64()), pa.array(totals, pa.int64())],
                    names=names)

    return src.mapInArrow(run, out).withColumnRenamed("_key", key)


def join_fields(docs: DataFrame, fields: Sequence[str], key: str = "doc_id",
                separator: str = "\n") -> tuple[DataFrame, DataFrame]:
    """One text from several fields, and the fields' places in it as sections (0, 1, ... in order).

    A null field is empty.  The separator belongs to no section.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    whole = docs.select(F.col(f"`{key}`").alias(key), F.concat_ws(separator, *parts).alias("text"))
    at, places = F.lit(0), []
    for i, p in enumerate(parts):
        places.append(F.struct(F.lit(i).cast("long").alias("section_id"), at.cast("long").alias("start"),
                               (at + F.length(p)).cast("long").alias("stop")))
        at = at + F.length(p) + len(separator)
    sections = docs.select(F.col(f"`{key}`").alias(key), F.explode(F.array(*places)).alias("s")).select(key, "s.*")
    return whole, sections
