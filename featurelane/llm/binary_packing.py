"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding.

A document's n tokens (its ids and the end id) are cut into pieces whose lengths are
powers of two: as many pieces of ``max_length`` as fit, then one piece for each
binary digit of the rest, longest first.  Each piece is a sequence of its own,
at offset 0, and its length is a power of two, so it isn't padded.  ``bucket`` is the
base-2 logarithm of the length: a training job draws every batch from one bucket
(``batches_by_bucket`` lays them out), with more sequences a batch in the shorter ones.

One pass over the texts and no shuffle: a document's pieces depend on nothing but
the document.  ``sequence_id`` is unique over the result and follows the input's
partitions and rows.

Results by case: a null or empty text is the end id alone (one piece of length 1); a very long
text gives many pieces of ``max_length``; rows that repeat are packed each; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featurelane.llm.tokens import BYTE_BPE, encoder, read_vocabulary
from featurelane.llm.words import spans, text_bytes

MAX_LENGTH = 2048
END_ID = 1
_OUT = "start long, length long, doc_tokens long, ids binary"


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Powers of two that sum to n, longest first, none above ``max_length``."""
    out = [max_length] * (n // max_length)
    rest = n % max_length
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_documents(docs: DataFrame, vocabulary: str = BYTE_BPE, text: str = "text", key: str = "doc_id",
                   max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: key, sequence_id, bucket, start, length, offset, doc_tokens, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit values.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))  # the vocabulary file: fixed size
    src = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in spans(off):
                rows, start, length, total, ids = [], [], [], [], []
                for r in range(i, j):
                    all_ids = np.append(enc.ids(data[off[r]:off[r + 1]]), end_id).astype("<u4")
                    at = 0
                    for n in piece_lengths(len(all_ids), max_length):
                        rows.append(r)
                        start.append(at)
                        length.append(n)
                        total.append(len(all_ids))
                        ids.append(all_ids[at:at + n].tobytes())
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                    names=["_key", "start", "length", "doc_tokens", "ids"])

    out = StructType([src.schema["_key"], *StructType.fromDDL(_OUT)])
    pieces = src.mapInArrow(run, out)
    return pieces.select(F.col("_key").alias(key), F.monotonically_increasing_id().alias("sequence_id"),
                         F.round(F.log2("length")).cast("int").alias("bucket"), "start", "length",
                         F.lit(0).cast("long").alias("offset"), "doc_tokens", "ids")


def batches_by_bucket(pieces: DataFrame, path: str) -> None:
    """Write pieces as Parquet, one folder per bucket, so that a batch holds equal lengths."""
    pieces.write.partitionBy("bucket").parquet(path)
