"""Intermediate tables in the shared checkpoint folder, and bitmaps of ids.

``stage`` writes a DataFrame as Parquet below the folder that ``spark.checkpoint.dir`` names and
reads it back: lineage ends there, a lost executor costs a re-read and no recomputation, and later
readers take only the columns they need.

``bitmap`` marks the values of a column in a bit array of fixed size (8 MB at the default), built by a
distributed bitwise-or and broadcast.  It never misses a marked value; it may pass others
(1 - exp(-values / bits) of them), so an exact join always follows.  It saves shuffles of
whole texts: rows that surely match nothing do not enter that join.  When it fills up at
larger scale, results stay the same and only the saving shrinks.

``few`` reads a staged table of bounded size in one task: joins and aggregates of such tables need no shuffle, which
would cost a task for every shuffle partition, mostly empty ones.  A larger table is shuffled as ever.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.llm.words import U, mix
from featurelane.session import checkpoint_dir

LOG2_BITS = 26
_PACK = 13  # 2**13 words of 64 bits a pack
#: Slots held back by a task until they are sent to their packs.
HELD = 1 << 18
#: Tasks that gather packs (there are 2**(LOG2_BITS - 19) at most): more would be idle.
_GATHER = 32
#: Rows, and bytes of their payload, that one task takes rather than a shuffle.
FEW = 1 << 18
FEW_BYTES = 1 << 25


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(staged: DataFrame, most: int = FEW, payload: str | None = None) -> DataFrame:
    """``staged`` (narrow rows, from ``stage``) in one partition if it has at most ``most`` rows, else as it is.

    ``payload``: a wide column, whose bytes are bounded too.
    """
    size = F.lit(0) if payload is None else F.octet_length(payload)
    rows, wide = staged.agg(F.count(F.lit(1)), F.sum(size)).first()
    return staged.coalesce(1) if rows <= most and (wide or 0) <= FEW_BYTES else staged


def id_hash(column: str) -> Column:
    """A long for any key column, null included (the same as ``hash_ids`` for longs)."""
    return F.xxhash64(F.col(f"`{column}`"))


class Bitmap:
    """Membership in a broadcast bit array; for use inside tasks."""

    def __init__(self, shared, log2_bits: int):
        self.shared, self.log2_bits = shared, log2_bits

    def has(self, values: np.ndarray) -> np.ndarray:
        slot = values.astype(np.int64).view(U) & U((1 << self.log2_bits) - 1)
        words = self.shared.value
        return (words[(slot >> U(6)).astype(np.int64)] >> (slot & U(63)) & U(1)).astype(bool)

    def free(self) -> None:
        """Give the broadcast bits back, once all that tests them is staged."""
        self.shared.destroy()

    def column(self, values: Column) -> Column:
        """Boolean column: may ``values`` (longs) be marked?"""
        @F.pandas_udf("boolean")
        def marked(v: pd.Series) -> pd.Series:
            return pd.Series(self.has(v.to_numpy()))
        return marked(values)


def bitmap(df: DataFrame, column: str, log2_bits: int = LOG2_BITS, through: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> Bitmap:
    """Bitmap of a long column (no nulls) whose low bits are random (hashes); values may repeat.  One shuffle.

    ``through``: the values are the first column of what it makes of ``df``'s batches, in the same Python worker.
    """
    mask, width = (1 << log2_bits) - 1, _PACK + 6

    def send(batches):
        held, n = [], 0
        for batch in batches if through is None else through(batches):
            held.append(np.unique(batch.column(0).to_numpy() & mask))
            n += len(held[-1])
            if n >= HELD:
                yield from packs(held)
                held, n = [], 0
        if n:
            yield from packs(held)

    def packs(held):
        slots = np.unique(np.concatenate(held))
        p = slots >> width
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        rest = (slots & ((1 << width) - 1)).astype("<u4")
        yield pa.RecordBatch.from_arrays([pa.array(p[first]), pa.array([r.tobytes() for r in np.split(rest, first[1:])], pa.binary())], names=["p", "x"])

    def pack(batches):
        full = {}
        for batch in batches:
            for p, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                bits = full.setdefault(p, np.zeros(1 << width, bool))
                bits[np.frombuffer(x.as_buffer(), "<u4")] = True
        for p, bits in full.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["p", "x"])

    packed = (df.select(column) if through is None else df).mapInArrow(send, "p long, x binary").repartition("p").coalesce(_GATHER).mapInArrow(pack, "p long, x binary")
    out = np.zeros(max(1 << _PACK, 1 << (log2_bits - 6)), U)
    for p, blob in packed.collect():  # 2**(log2_bits - 19) rows at most
        out[p << _PACK:(p + 1) << _PACK] = np.frombuffer(blob, U)
    return Bitmap(df.sparkSession.sparkContext.broadcast(out), log2_bits)


__all__ = ["Bitmap", "bitmap", "few", "id_hash", "mix", "stage", "stage_path"]
