"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines, long ones in pieces that end at words chosen by their hash, one in ``PIECE``, so that a word put in or taken
out changes the pieces next to it alone; each has a 64-bit digest (the r-th repeat of a paragraph has a digest of its own).  The sketch has three parts of ``m`` cells (a power of two); a digest
goes to one cell of each part, which keeps a count, the xor of its digests and the xor of their checks.
Sketches are linear: the difference of two holds the digests that only one text has, and peeling (taking digests
that are alone in a cell, again and again) recovers them.  If cells remain, the sketches were too small:
both are made again at twice the size until it succeeds.  A sketch of twice the size folds to the smaller one,
so sketches of different sizes compare at the smaller.

A fingerprint is the sketch itself as text: ``parse`` reads it back, and ``compare`` folds, subtracts and peels two of
them without their texts, or says that they are too small for what differs.

All pairs of a batch of rows are peeled together, column-wise.

``compare_next`` compares each document with its edited version and with the next document by key.
Documents are dealt into ranges of the key and the first of each range is also sent to the range before it, so
the texts cross one shuffle and no task holds more than a range.

Results by case: a null text is empty; an empty text has an empty sketch, like to itself by 1 and to any other
by 0; the last document's next is the first, also its own if it is alone; rows of equal key are ordered by
text; a null key comes first; an empty table gives no rows; other columns are left out.  The key is a whole number.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelane.llm.words import U, Words, mix, spans, text_bytes

PIECE = 8
PARTS = 3
LEAST = 4
_CHECK = U(0xA24BAED4963EE407)
_SEEDS = [U(0x9FB21C651E98DF25), U(0xD1342543DE82EF95), U(0xC13FA9A902A6328F)]
_Q = U(0x9E3779B185EBCA87)
_LEAST_KEY = -(1 << 63)
_CELL = np.dtype([("n", "<u2"), ("k", "<u8"), ("c", "<u4")])


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all rows' paragraphs, and where each row's begin (n + 1 places)."""
    w = Words(data, offsets)
    n = len(w.start)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    row = np.searchsorted(offsets, w.start, "right") - 1
    line = np.searchsorted(np.flatnonzero(data == 10), w.start)
    new = np.ones(n, bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    new[1:] |= mix(w.hash[:-1]) % U(PIECE) == 0  # the word before ends a piece
    begin = np.flatnonzero(new)
    at = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    power = np.multiply.accumulate(np.full(at.max() + 1, _Q, U))
    digest = mix(np.add.reduceat(w.hash * power[at], begin))
    owner = row[begin]
    # the r-th repeat of a digest in a row gets a digest of its own
    order = np.lexsort((digest, owner))
    same = np.ones(len(order), bool)
    same[1:] = (digest[order][1:] != digest[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    start = np.maximum.accumulate(np.where(same, np.arange(len(order)), 0))
    repeat = np.empty(len(order), np.int64)
    repeat[order] = np.arange(len(order)) - start
    again = repeat > 0
    digest[again] = mix(digest[again] + repeat[again].astype(U) * _Q)
    return digest, np.searchsorted(owner, np.arange(len(offsets)))


def sketch_size(n: np.ndarray) -> np.ndarray:
    """Cells of each part for a text of n paragraphs: a power of two, an eighth of n or more."""
    need = np.maximum(LEAST, -(-np.asarray(n) // 8))
    return 1 << np.ceil(np.log2(need)).astype(np.int64)


def _cells(keys: np.ndarray, base: np.ndarray, m: np.ndarray) -> Iterator[np.ndarray]:
    for part, seed in enumerate(_SEEDS):
        yield base + part * m + (mix(keys ^ seed) & (m - 1).astype(U)).astype(np.int64)


def _proof(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _CHECK) >> U(32)


def _begins(m: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(PARTS * m)))


def sketches(keys: np.ndarray, sign: np.ndarray, owner: np.ndarray, m: np.ndarray):
    """Cells (count, key, check) of all owners one after the other, and where each owner's begin."""
    base = _begins(m)
    count, key, check = np.zeros(base[-1], np.int64), np.zeros(base[-1], U), np.zeros(base[-1], U)
    proof = _proof(keys)
    for cell in _cells(keys, base[owner], m[owner]):
        np.add.at(count, cell, sign)
        np.bitwise_xor.at(key, cell, keys)
        np.bitwise_xor.at(check, cell, proof)
    return count, key, check, base


def peel(count: np.ndarray, key: np.ndarray, check: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peel subtracted sketches (which it uses up): (owners that succeeded, recovered digests, their signs, their owners)."""
    base = _begins(m)
    cell_owner = np.repeat(np.arange(len(m)), PARTS * m)
    found = [(np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    look = np.arange(len(count))
    for _ in range(10_000):
        pure = look[np.abs(count[look]) == 1]
        pure = pure[check[pure] == _proof(key[pure])]
        if not len(pure):
            break
        _, one = np.unique(mix(key[pure] + cell_owner[pure].astype(U) * _Q), return_index=True)
        pure = pure[one]
        k, s, o = key[pure].copy(), count[pure].copy(), cell_owner[pure]
        found.append((k, s, o))
        proof, touched = _proof(k), []
        for cell in _cells(k, base[o], m[o]):
            np.subtract.at(count, cell, s)
            np.bitwise_xor.at(key, cell, k)
            np.bitwise_xor.at(check, cell, proof)
            touched.append(cell)
        look = np.unique(np.concatenate(touched))
    left = np.add.reduceat(((count != 0) | (key != 0) | (check != 0)).astype(np.int64), base[:-1]) if len(m) else np.zeros(0, np.int64)
    k, s, o = (np.concatenate(x) for x in zip(*found))
    return left == 0, k, s, o


def subtract(a, a_m: np.ndarray, b, b_m: np.ndarray):
    """Cells (count, key, check) of a less b, pair by pair, folded to the smaller of both sizes, and these sizes."""
    to = np.minimum(a_m, b_m)
    base = _begins(to)
    count, key, check = np.zeros(base[-1], np.int64), np.zeros(base[-1], U), np.zeros(base[-1], U)
    for cells, m, sign in ((a, a_m, 1), (b, b_m, -1)):
        owner = np.repeat(np.arange(len(m)), PARTS * m)
        place = np.arange(len(owner)) - _begins(m)[owner]
        cell = base[owner] + place // m[owner] * to[owner] + (place % m[owner] & (to[owner] - 1))
        np.add.at(count, cell, sign * cells[0])
        np.bitwise_xor.at(key, cell, cells[1])
        np.bitwise_xor.at(check, cell, cells[2])
    return count, key, check, to


def _counts(ok: np.ndarray, sign: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bincount(owner[sign > 0], minlength=len(ok)), np.bincount(owner[sign < 0], minlength=len(ok))


def differences(a, a_m: np.ndarray, b, b_m: np.ndarray, digest: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests that only a has and that only b has, counted for each pair of sketches.

    Where two sketches are too small for the difference, both are made again, from the digests a_at[i]:a_at[i+1] and b likewise, at twice the size.
    """
    count, key, check, m = subtract(a, a_m, b, b_m)
    ok, _, s, o = peel(count, key, check, m)
    only_a, only_b = _counts(ok, s, o)
    na, nb = np.diff(a_at), np.diff(b_at)
    keys = np.concatenate((digest[a_at[0]:a_at[-1]], digest[b_at[0]:b_at[-1]]))
    sign = np.repeat([1, -1], [na.sum(), nb.sum()])
    owner = np.concatenate((np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)))
    todo = np.flatnonzero(~ok)
    while len(todo):
        m[todo] *= 2
        place = np.full(len(m), -1)
        place[todo] = np.arange(len(todo))
        mine = place[owner] >= 0
        ok, _, s, o = peel(*sketches(keys[mine], sign[mine], place[owner[mine]], m[todo])[:3], m[todo])
        found_a, found_b = _counts(ok, s, o)
        only_a[todo[ok]], only_b[todo[ok]] = found_a[ok], found_b[ok]
        todo = todo[~ok]
    return only_a, only_b


def likeness(na: np.ndarray, nb: np.ndarray, only_a: np.ndarray, only_b: np.ndarray) -> np.ndarray:
    """Common paragraphs over all paragraphs; 1 for two empty texts."""
    both = na + nb - only_a - only_b  # counted twice
    total = both / 2 + only_a + only_b
    return np.where(total > 0, both / 2 / np.where(total > 0, total, 1), 1.0)


def fingerprints(cells, m: np.ndarray) -> list[str]:
    """Each row's sketch as text: its part size, then 14 bytes a cell (count, digest, check) in base 64."""
    base = 14 * _begins(m)
    raw = np.zeros(len(cells[0]), _CELL)
    for name, values in zip(_CELL.names, cells):
        raw[name] = values
    raw = raw.tobytes()
    return [f"{m[i]}:{base64.b64encode(raw[base[i]:base[i + 1]]).decode()}" for i in range(len(m))]


def parse(fingerprint: str) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int]:
    """The cells (count, key, check) of a fingerprint and its part size."""
    m, _, cells = fingerprint.partition(":")
    raw = np.frombuffer(base64.b64decode(cells), _CELL)
    return (raw["n"].astype(np.int64), raw["k"].astype(U), raw["c"].astype(U)), int(m)


def compare(a: str, b: str) -> tuple[float, np.ndarray, np.ndarray] | None:
    """Likeness of two fingerprints, and the paragraph digests that only a and only b have; None if they are too small to tell."""
    (ca, ma), (cb, mb) = parse(a), parse(b)
    count, key, check, m = subtract(ca, np.array([ma]), cb, np.array([mb]))
    ok, k, s, _ = peel(count, key, check, m)
    if not ok[0]:
        return None
    only = k[s > 0], k[s < 0]
    n = [np.array([c[0][:size].sum()]) for c, size in ((ca, ma), (cb, mb))]  # each paragraph is once in the first part
    return float(likeness(*n, *(np.array([len(x)]) for x in only))[0]), *only


_OUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
        "n_removed long, n_added long")


def _compare(keys: pa.Array, texts: list[str], names: list[str]) -> pa.RecordBatch:
    """Rows for all texts but the last, each against its edited version and the text after it."""
    edited = [t[:len(t) - len(t) // 4] + u[:len(t) // 4] for t, u in zip(texts, texts[1:])]
    data, off = text_bytes(pa.array(texts + edited, pa.large_string()))
    digest, at = paragraphs(data, off)
    n = len(edited)
    size = np.diff(at)
    m = sketch_size(size)
    *cells, base = sketches(digest, np.ones(len(digest), np.int64), np.repeat(np.arange(len(size)), size), m)

    def rows(i: int):  # n sketches from the i-th on, their sizes, and where their digests are
        return [c[base[i]:base[i + n]] for c in cells], m[i:i + n], at[i:i + n + 1]

    (own, own_m, own_at), (nxt, nxt_m, nxt_at), (new, new_m, new_at) = rows(0), rows(1), rows(n + 1)
    gone, come = differences(own, own_m, new, new_m, digest, own_at, new_at)
    a, b = differences(own, own_m, nxt, nxt_m, digest, own_at, nxt_at)
    near_edited = likeness(size[:n], size[n + 1:], gone, come)
    near_next = likeness(size[:n], size[1:n + 1], a, b)
    sha = [hashlib.sha256(data[off[n + 1 + i]:off[n + 2 + i]]).hexdigest() for i in range(n)]
    cols = [pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array(sha), pa.array(fingerprints(own, own_m)),
            pa.array(fingerprints(new, new_m)), pa.array(near_edited), pa.array(near_next), pa.array(gone), pa.array(come)]
    return pa.RecordBatch.from_arrays([keys, *cols], names=names)


def compare_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_chars, edited_sha256, both fingerprints, their likeness, and the paragraphs the edit removed and added.

    The edited text has its last quarter replaced by the beginning of the next document's text.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_LEAST_KEY)).alias("k"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range borders: one number per range, whatever the input's size
    borders = np.unique(np.array(plain.select("k").approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.1 / ranges), np.float64).astype(np.int64))
    shared = spark.sparkContext.broadcast(borders)

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, k.to_numpy(), "right").astype(np.int32))

    firsts = sorted((r["k"], r["r"]) for r in plain.select("k", range_of("k").alias("r")).groupBy("r").agg(F.min("k").alias("k")).collect())
    before = {k: firsts[i - 1][1] for i, (k, _) in enumerate(firsts)}  # a range's first key: the range before it
    first_keys = spark.sparkContext.broadcast((np.array([k for k, _ in firsts], np.int64), np.array([before[k] for k, _ in firsts], np.int32)))

    @F.pandas_udf("int")
    def also_to(k: pd.Series) -> pd.Series:
        known, to = first_keys.value
        v = k.to_numpy()
        i = np.minimum(np.searchsorted(known, v), len(known) - 1)
        return pd.Series(np.where(known[i] == v, to[i], -1).astype(np.int32))

    sent = plain.select("doc_id", "text", "k", F.explode(F.array(
        F.struct(range_of("k").alias("r"), F.lit(0).alias("halo")), F.struct(also_to("k").alias("r"), F.lit(1).alias("halo")))).alias("to"))
    sent = sent.select("doc_id", "text", "k", "to.r", "to.halo").where("r >= 0")
    kind = docs.select(F.col(f"`{key}`").alias("doc_id")).schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(c.split()[0] for c in _OUT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            data, off = text_bytes(batch.column(1))
            r, halo = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            last = batch.num_rows - 1
            for i, j in spans(off[:last + 1], 1 << 18) if last else ():
                # runs of rows of one range, each with the row after it
                rows = np.arange(i, j)
                rows = rows[(halo[rows] == 0) & (r[rows] == r[rows + 1])]
                cut = np.flatnonzero(np.diff(rows) != 1) + 1
                for run_ in np.split(rows, cut):
                    if len(run_):
                        texts = batch.column(1).slice(run_[0], len(run_) + 1).to_pylist()
                        yield _compare(batch.column(0).slice(run_[0], len(run_)), texts, names)
            held = batch.slice(last, 1)  # its next row is in the next batch, if it has one

    dealt = sent.repartition(ranges // 4, "r").sortWithinPartitions("r", "halo", "k", "text")
    return dealt.select("doc_id", "text", "r", "halo").mapInArrow(run, f"doc_id {kind}, {_OUT}").withColumnRenamed("doc_id", key)
