"""Quality rules by compression bands (zstandard).

A text that repeats itself compresses far better than prose, and random or
encoded bytes hardly compress at all.  Both show in ``compressed / raw`` size,
but the ratio also falls with length, since a longer text gives the compressor more to refer
back to and the frame header weighs less.  The limits therefore depend on the
length: ``BANDS`` lists (bytes up to, lowest ratio, highest ratio).

Two verdicts are combined: the ratio of the whole text against the band of its
length, and the ratios of fixed chunks of ``CHUNK`` bytes, each compressed on
its own against the band of its length (the last one is shorter).  A text is rejected if its whole
ratio is outside, or if more than ``BAD_CHUNKS`` percent of its bytes are in chunks that are
outside (a local table or code block alone does not reject it).

Results by case: a null or empty text has no words, ratio null, fails the base
rules; a text shorter than the first band is judged by the first band; any extra
columns pass through ``with_compression`` untouched, and rows that repeat are
judged alike.  One pass over the texts, no shuffle, memory bounded by one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelane.llm.words import row_blocks, windows

LEVEL = 3
CHUNK = 4096
BAD_CHUNKS = 50
WINDOW = 5
#: (texts of up to so many bytes, lowest ratio, highest ratio): fixed values.
BANDS = (
    (128, 0.50, 1.35),
    (256, 0.42, 1.10),
    (512, 0.40, 0.92),
    (1024, 0.36, 0.85),
    (2048, 0.33, 0.78),
    (4096, 0.31, 0.72),
    (16384, 0.28, 0.68),
    (None, 0.22, 0.66),
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "n_bytes long, ratio double, n_chunks long, n_bad_chunks long, min_chunk_ratio double, "
        "max_chunk_ratio double, band_ok boolean")


def band(n_bytes: int) -> tuple[float, float]:
    """Lowest and highest ratio allowed for a text of that many bytes."""
    return next((lo, hi) for most, lo, hi in BANDS if most is None or n_bytes <= most)


def dup_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeat_words(words: np.ndarray, k: int = WINDOW) -> int:
    """Words inside k-word windows that occur twice or more."""
    w = windows(words, k)
    if not len(w):
        return 0
    _, back, n = np.unique(w, return_inverse=True, return_counts=True)
    at = np.flatnonzero(n[back] > 1)
    if not len(at):
        return 0
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + k, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def bands(raw: bytes, compressor: zstandard.ZstdCompressor) -> tuple:
    """(ratio, chunks, chunks outside their band, least and largest chunk ratio, verdict)."""
    n = len(raw)
    if not n:
        return None, 0, 0, None, None, False
    ratio = len(compressor.compress(raw)) / n
    lo, hi = band(n)
    sizes = [min(CHUNK, n - i) for i in range(0, n, CHUNK)]
    chunks = [len(compressor.compress(raw[i * CHUNK:(i + 1) * CHUNK])) / size for i, size in enumerate(sizes)]
    bad = [size for c, size in zip(chunks, sizes) if not band(size)[0] <= c <= band(size)[1]]
    ok = lo <= ratio <= hi and 100 * sum(bad) <= BAD_CHUNKS * n
    return ratio, len(chunks), len(bad), min(chunks), max(chunks), ok


def _measure(text: str, schema: pa.Schema, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        for batch, w in row_blocks(batches, text):
            data, off = w.data, w.offsets
            total = np.concatenate(([0], np.cumsum(w.inside & ((data & 0xC0) != 0x80))))
            chars = total[off[1:]] - total[off[:-1]]
            total = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
            symbols = total[off[1:]] - total[off[:-1]]
            rows = []
            for r in range(len(off) - 1):
                raw = data[off[r]:off[r + 1]].tobytes()
                words = w.of(r)
                rows.append((len(words), int(chars[r]), int(symbols[r]), dup_lines(raw), repeat_words(words), len(raw),
                             *bands(raw, compressor)))
            made = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[len(names):])]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + made, schema=schema)
    return run


def compression_columns(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of each row with its base counts, ratios and verdict (``base_failed``, ``kept``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    cols = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]
    src = docs.select(*cols, F.col(f"`{text}`").cast("string").alias("_text"))
    names = [f"_k{i}" for i in range(len(keep))]
    out = StructType(list(src.select(*names).schema) + list(StructType.fromDDL(_OUT)))
    got = src.mapInArrow(_measure("_text", to_arrow_schema(out), names), out)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return got.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                      *[f.name for f in StructType.fromDDL(_OUT)],
                      failed.alias("base_failed"), (~failed & F.col("band_ok")).alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the bands, all columns as they are; each text goes to the task and back once."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructType

    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]
    src = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)])
    kind = src.schema
    read = names[columns.index(text)]
    if not isinstance(kind[read].dataType, StringType):
        src, read = src.withColumn("_text", F.col(read).cast("string")), "_text"
    measure = _measure(read, to_arrow_schema(StructType(list(kind) + list(StructType.fromDDL(_OUT)))), names)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in measure(batches):
            words, repeated = (batch.column(c).to_numpy() for c in ("n_words", "n_repeat_words"))
            ok = (words >= 10) & (100 * repeated <= 20 * words) & batch.column("band_ok").to_numpy(zero_copy_only=False).astype(bool)
            yield batch.select(names).filter(pa.array(ok))

    got = src.mapInArrow(kept, kind)
    return got.select(*[F.col(n).alias(c) for c, n in zip(columns, names)])
