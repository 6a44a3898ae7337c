"""Best-fit packing by sums of squares: documents into as few fixed-length sequences as they fit.

Only documents longer than a sequence are cut: full pieces fill sequences of their own, and the first piece is the
remainder.  Every other piece is placed whole.  Among the open sequences that it fits, a piece goes where the sum over
the residual gaps g of N(g)**2 becomes smallest, N(g) being the number of open sequences with g tokens left: it takes a
common gap and leaves a rare one, so that the gaps stay varied and later pieces find one that suits them.  Pieces come
in descending length and a sequence is opened only where none fits; the plain rule, which also weighs a new sequence
by its square, gave 1.5 % more sequences than the tokens need on 20,000 test documents, this one 0.2 %.

Scale: one pass encodes the texts and writes the pieces; then each packer (``PER_PACKER`` pieces at most in the mean, dealt by
a hash of their row number, so that equal keys, texts or lengths are spread evenly) packs its own.  A
packer leaves some dozens of sequences part full, some 0.2 % of its own.  The number of packers follows
from the number of pieces, and a lost executor costs a re-read of the written pieces.

Results by case: a null or empty text is the end id alone, a piece of one token; a document of exactly the
sequence's length is one full piece; rows that repeat are packed each; null keys are kept; a very long text
gives one piece per sequence length; an empty table gives no rows; other columns of the documents are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from featurelane.llm.stages import stage
from featurelane.llm.tokens import BYTE_BPE, encoder, read_vocabulary
from featurelane.llm.words import spans, text_bytes

MAX_LENGTH = 1024
END_ID = 2
PER_PACKER = 1 << 15
_OUT = "piece int, start long, length long, ids binary"


def encode_pieces(docs: DataFrame, vocabulary: str = BYTE_BPE, text: str = "text", key: str = "doc_id",
                  max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """key, piece, start, length and ids (little-endian unsigned 32-bit values) of every document's pieces."""
    if max_length < 1:
        raise ValueError("max_length must be 1 or more")
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # the vocabulary file: fixed size
    src = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in spans(off):
                rows, piece, start, length, ids = [], [], [], [], []
                for r in range(i, j):
                    whole = np.append(enc.ids(data[off[r]:off[r + 1]]), end_id).astype("<u4")
                    cuts = [*([0] if len(whole) % max_length else []), *range(len(whole) % max_length, len(whole), max_length)]
                    for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(whole)])):
                        rows.append(r)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        ids.append(whole[a:b].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["_key", "piece", "start", "length", "ids"])

    return src.mapInArrow(run, StructType([src.schema["_key"], *StructType.fromDDL(_OUT)])).withColumnRenamed("_key", key)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of pieces (1 to ``capacity`` tokens, longest first) by the sum-of-squares rule."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones count nothing
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for at, n in enumerate(lengths.tolist()):
        gaps = count[n:]
        fits = np.flatnonzero(gaps)
        if len(fits):
            left = count[fits]  # sequences that already have the gap that remains
            change = 2 * left - 2 * gaps[fits] + 2
            if fits[0] == 0:
                change[0] = 1 - 2 * gaps[0]
            rest = int(fits[np.argmin(change)])
            gap = rest + n
            count[gap] -= 1
            seq = free[gap].pop()
        else:
            gap, rest, seq = capacity, capacity - n, used
            used += 1
        number[at], offset[at] = seq, capacity - gap
        if rest:
            count[rest] += 1
            free[rest].append(seq)
    return number, offset


def pack_pieces(pieces: DataFrame, capacity: int = MAX_LENGTH, per_packer: int = PER_PACKER) -> DataFrame:
    """All columns of ``pieces``, with sequence_id and offset.

    ``length`` is between 1 and ``capacity``.  Full pieces have sequences numbered below 0, packed ones from 0 on.
    """
    rows = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full, rest = rows.where(F.col("length") >= capacity), rows.where(F.col("length") < capacity)
    packers = max(1, -(-rest.count() // per_packer))
    out = StructType([*rows.drop("_row").schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("_row", "ascending")])
        number, offset = place(table.column("length").to_numpy(), capacity)
        base = table.column("_packer")[0].as_py() << 32
        table = table.append_column("sequence_id", pa.array(number + base)).append_column("offset", pa.array(offset))
        return table.select(out.names)

    packed = rest.withColumn("_packer", F.pmod(F.xxhash64("_row"), F.lit(packers))).groupBy("_packer").applyInArrow(pack, out)
    alone = full.select(*[F.col(f"`{c}`") for c in out.names[:-2]], (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and the concatenated ids of every sequence (``capacity`` tokens at most)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts")).select(
        "sequence_id", "length", F.aggregate("_parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
