"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of 0 to 3 bytes with the counts of the byte that followed.  The code
length of a byte is taken in the longest context that has seen it; every longer context that exists costs its
escape, with probability ``distinct / (total + distinct)`` (method C); below order 0 all 64 symbols are
alike.  The statistics are frozen after training, so every code length is known beforehand: they are
tabled for all contexts, and a text's length under all languages is a gather and a sum over its bytes.
A text gets the language with the shortest code (the language's own share costs bits too).

Bytes are first folded: upper-case ASCII to lower case, white space to space, digits to 0; the 63 most frequent
ones are symbols, all others one symbol.

Bounds (documented parameters): training takes about ``SAMPLE_DOCS`` whole texts per language, chosen by a
hash of the key; ``MAX_CONTEXTS`` contexts of 3 bytes are kept, the most frequent, shorter contexts all.
The table that is broadcast has at most (``MAX_CONTEXTS`` + 4096) * 64 numbers per language.

Results by case: null texts and texts without a letter are ``und`` with score 0; training rows with a null
language, text or key are left out; without training rows all is ``und``; an empty table gives no rows; equal
code lengths go to the language that is first in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.llm.words import spans, text_bytes

SAMPLE_DOCS = 1500
MAX_CONTEXTS = 16384
SYMBOLS = 64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_FOLD[48:58] = 48
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class Model:
    """Languages, their prior bits, the byte symbols, and the code-length table with its row for every 3-symbol context."""

    languages: list[str]
    prior: np.ndarray
    symbol: np.ndarray
    row: np.ndarray
    bits: np.ndarray


def padded(data: np.ndarray, offsets: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows one after the other, each with three blanks before it, and the places of the rows' own bytes."""
    n = len(offsets) - 1
    place = np.arange(len(data)) + 3 * (np.searchsorted(offsets, np.arange(len(data)), "right"))
    out = np.full(len(data) + 3 * n, blank, np.int64)
    out[place] = data
    return out, place


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, four folded bytes as a number, count) of (lang, text) rows."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        data, off = text_bytes(batch.column(1))
        for i, j in spans(off, 1 << 18):
            x, at = padded(_FOLD[data[off[i]:off[j]]], off[i:j + 1] - off[i], 32)
            code = (x[at - 3] << 24) | (x[at - 2] << 16) | (x[at - 1] << 8) | x[at]
            owner = np.repeat(langs[i:j], np.diff(off[i:j + 1]))
            for lang in sorted(set(langs[i:j])):
                grams, n = np.unique(code[owner == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)],
                                                 names=["lang", "gram", "n"])


def _code_lengths(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of every symbol in every context, given the symbol's bits in the context without its first byte."""
    total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    whole = np.maximum(total + distinct, 1)
    escape = np.where(total > 0, -np.log2(np.maximum(distinct, 1) / whole), 0.0)
    return np.where(counts > 0, -np.log2(np.maximum(counts, 1) / whole), escape + shorter)


def build(languages: list[str], shares: np.ndarray, lang: np.ndarray, gram: np.ndarray, n: np.ndarray,
          max_contexts: int = MAX_CONTEXTS) -> Model:
    """The frozen model of counted grams (language index, four bytes, count)."""
    seen = np.bincount(gram & 255, n, 256)
    symbol = np.full(256, SYMBOLS - 1, np.int64)
    common = np.argsort(-seen, kind="stable")[:SYMBOLS - 1]
    symbol[common] = np.arange(len(common))
    code = np.zeros(len(gram), np.int64)
    for shift in (24, 16, 8, 0):
        code = code << 6 | symbol[gram >> shift & 255]
    contexts, back = np.unique(code >> 6, return_inverse=True)
    kept = np.sort(np.argsort(-np.bincount(back, n), kind="stable")[:max_contexts])
    contexts3 = contexts[kept]
    rank = np.full(len(contexts), -1)
    rank[kept] = np.arange(len(kept))
    row = len(contexts3) + (np.arange(1 << 18) & 4095)
    row[contexts3] = np.arange(len(contexts3))
    bits = np.empty(((len(contexts3) + 4096) * SYMBOLS, len(languages)), np.float32)
    for k in range(len(languages)):
        mine = lang == k
        c, w = code[mine], n[mine]
        shorter = np.full((1, SYMBOLS), np.log2(SYMBOLS))
        for size, at in ((1, c & 63), (64, c & 4095), (4096, c & 0x3FFFF)):
            counts = np.bincount(at, w, size * SYMBOLS).reshape(size, SYMBOLS)
            # a context's suffix is its code without the first symbol
            shorter = _code_lengths(counts, shorter[np.arange(size) % max(1, size // SYMBOLS)])
        r = rank[back[mine]]
        at = r[r >= 0] * SYMBOLS + (c[r >= 0] & 63)
        counts = np.bincount(at, w[r >= 0], len(contexts3) * SYMBOLS).reshape(-1, SYMBOLS)
        bits[:len(contexts3) * SYMBOLS, k] = _code_lengths(counts, shorter[contexts3 & 4095]).ravel()
        bits[len(contexts3) * SYMBOLS:, k] = shorter.ravel()
    return Model(languages, -np.log2(shares / shares.sum()), symbol, row, bits)


def code_bits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code length of every row under every language."""
    x, at = padded(model.symbol[_FOLD[data]], offsets, int(model.symbol[32]))
    rows = model.row[(x[at - 3] << 12) | (x[at - 2] << 6) | x[at - 1]] * SYMBOLS + x[at]
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(model.bits[rows], offsets[:-1][full], axis=0)
    return out


def train(rows: DataFrame, sample_docs: int = SAMPLE_DOCS, max_contexts: int = MAX_CONTEXTS) -> Model | None:
    """The model of (key, text, lang) rows; None without any."""
    rows = rows.where("key is not null and text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one per language
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("key", F.lit(6)), F.lit(1 << 30)) / (1 << 30)
    rate = F.element_at(F.create_map(*[F.lit(x) for l in languages for x in (l, min(1.0, sample_docs / counts[l]))]), F.col("lang"))
    picked = rows.where(draw < rate).select("lang", "text")
    # grams of the bounded sample
    grams = picked.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    index = {l: i for i, l in enumerate(languages)}
    return build(languages, np.array([counts[l] for l in languages], float), grams["lang"].map(index).to_numpy(),
                 grams["gram"].to_numpy(), grams["n"].to_numpy(), max_contexts)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter of any script."""
    total = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    out = total[offsets[1:]] > total[offsets[:-1]]
    for r in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[r] = any(c.isalpha() for c in data[offsets[r]:offsets[r + 1]].tobytes().decode())
    return out


def identify(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """key, lang_pred, score and the bits per byte of the best code, learnt from the rows where ``training`` holds."""
    labelled = docs.where(training).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"),
                                           F.col(f"`{lang}`").cast("string").alias("lang"))
    model = train(labelled, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters

    def run(batches):
        m = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in spans(off, 1 << 18):
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                known = has_letter(part, o) if m else np.zeros(j - i, bool)
                pred, score, per_byte = np.full(j - i, "und", object), np.zeros(j - i), np.full(j - i, np.nan)
                if m:
                    bits = code_bits(m, part, o)
                    total = bits + m.prior
                    best = total.argmin(1)
                    least = total.min(1)
                    sure = 1 / np.exp2(np.maximum(least[:, None] - total, -1000)).sum(1)
                    pred[known] = np.array(m.languages, object)[best[known]]
                    score[known] = sure[known]
                    per_byte[known] = bits[np.arange(j - i), best][known] / np.diff(o)[known]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(pred.tolist(), pa.string()), pa.array(score),
                     pa.array(per_byte, pa.float64(), mask=~known)], names=["key", "lang_pred", "score", "bits_per_byte"])

    src = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, lang_pred string, score double, bits_per_byte double").withColumnRenamed("key", key)
