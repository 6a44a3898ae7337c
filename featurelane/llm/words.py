"""Words and word windows of whole texts as 64-bit hashes, column-wise with numpy.

A word is a run of bytes other than space and \\x09-\\x0D.  Those six delimiters
are ASCII and no byte of a multi-byte UTF-8 character equals one, so words are
found on the UTF-8 bytes that Arrow already holds; no Python string is made.

A word's hash is ``sum(T[byte_i] * P**i)`` modulo 2**64 (``T`` random per byte, ``P``
odd), mixed once more.  It depends on the bytes alone: not on the process, the
partition or the position in a batch, so separate scans agree, also after a
lost executor.  Two different words or windows collide with a chance of about
2**-58 each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text hashed at once; a longer text is taken in several pieces cut between words.
SPAN = 1 << 18
_rng = np.random.Generator(np.random.PCG64(20240229))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_T = _rng.integers(1, 2**64, 256, dtype=U) | U(1)
_T[SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_T_LOWER = _T[_LOWER]
_P = U(0x9E3779B97F4A7C13)
_P_INV = U(pow(int(_P), -1, 2**64))
_Q = U(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, SPAN), _powers(_P_INV, SPAN)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = offsets[0] if len(offsets) else 0
    return data[lo:offsets[-1]] if len(offsets) else data, offsets - lo


def spans(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` bytes together (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _hash_words(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), U)
    i, n, end = 0, len(starts), len(data)
    while i < n:
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, base + SPAN, "right")) - 1)
        if end - base <= SPAN:
            j = n
        stop = starts[j] if j < n else end
        part = data[base:stop]
        if len(part) <= SPAN:
            v = table[part] * _POW[:len(part)]
            at = starts[i:j] - base
            out[i:j] = np.add.reduceat(v, at) * _INV[at]
        else:  # one word (and the space after it) longer than SPAN
            total, scale = U(0), U(1)
            with np.errstate(over="ignore"):
                for k in range(0, len(part), SPAN):
                    piece = part[k:k + SPAN]
                    total += scale * (table[piece] * _POW[:len(piece)]).sum(dtype=U)
                    scale *= _POW[SPAN - 1] * _P
            out[i] = total
        i = j
    return mix(out)


class Words:
    """The words of a range of rows: first byte, row, hash; ``first[r]:first[r+1]`` are row r's."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        inside = ~SPACE[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edge = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[edge] = inside[edge]
        self.data, self.offsets, self.inside = data, offsets, inside
        self.start = np.flatnonzero(begin)
        self.first = np.searchsorted(self.start, offsets)
        self.hash = _hash_words(data, self.start, _T_LOWER if lower else _T)

    def of(self, row: int) -> np.ndarray:
        return self.hash[self.first[row]:self.first[row + 1]]

    def ends(self) -> np.ndarray:
        """The byte after each word's last."""
        total = np.concatenate(([0], np.cumsum(self.inside)))
        stop = np.append(self.start[1:], len(self.data))
        return self.start + (total[stop] - total[self.start])


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (none if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = words[:n].copy()
    factor = _Q
    with np.errstate(over="ignore"):
        for j in range(1, k):
            out += words[j:j + n] * factor
            factor *= _Q
    return mix(out)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; fewer words make one shingle; none make none."""
    if 0 < len(words) < k:
        return windows(words, len(words)) ^ U(len(words))
    return np.unique(windows(words, k))


def row_blocks(batches: Iterator[pa.RecordBatch], text: str = "text", lower: bool = False, limit: int = 1 << 18,
               only: Callable[[pa.RecordBatch], np.ndarray] | None = None) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of the Arrow batches with the words of their texts, about ``limit`` bytes at a time.

    ``only`` gives a mask of the rows to take; the others' words are not looked for.
    """
    for batch in batches:
        if only is not None:
            batch = batch.filter(pa.array(only(batch)))
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        for i, j in spans(offsets, limit):
            yield batch.slice(i, j - i), Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower)
    pa.default_memory_pool().release_unused()  # a worker that is used again keeps no more than it needs
