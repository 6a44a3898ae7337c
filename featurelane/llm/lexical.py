"""Ranked lexical search by dense blocked matrix products.

A block of items has a compact vocabulary: its own distinct terms, numbered.  One scan of the documents writes each
document's sparse vector over that vocabulary (term numbers and occurrences, with the document's term count);
the statistics N, L and df come from these vectors.  A second scan takes tiles of
documents: the terms that a tile holds make a dense float64 tile of impacts, and BLAS multiplies it by the block's
0/1 item tile of the same terms.  All factors are whole numbers; a term tile is no wider than keeps every partial sum
below 2**53, where float64 addition is exact in any order, and the tiles' products are added as int64.  Each task keeps
the k best documents of every item, ties by key, and a window over the tasks' survivors ranks them.

Scale: texts are read once for each block of items (``BLOCK_ITEMS`` items or ``BLOCK_TERMS`` terms; one item alone may have
more) and never move.  What is broadcast is the block: its term hashes, weights and 0/1 matrix, so the size is
bounded by these parameters or one item's text.  A task's dense tiles are ``TILE`` documents by ``TERM_TILE`` terms and by the block's items.
The vectors and the block's ranks are tables in the shared folder.

Terms are compared by 64-bit hashes of their bytes; two different terms collide with a chance of about 2**-58.

Results by case: a null or empty text has no term, is not counted and never found; an item without terms, or whose
terms occur nowhere, has no rows; a document of any length is one vector of at most the vocabulary's size; equal scores
rank by key, null keys last; rows that repeat are documents, or items, each; an empty table on either side gives no
rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from featurelane.llm.stages import stage, stage_path
from featurelane.llm.words import _T_LOWER, U, _hash_words, spans, text_bytes

TOP = 10
BLOCK_ITEMS, BLOCK_TERMS = 512, 8192
TILE, TERM_TILE = 512, 2048
_VECTORS = "doc_id long, n long, terms array<int>, counts array<long>"
#: Letters, digits and every byte of a character beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
_TABLE = np.where(INSIDE, _T_LOWER, U(0))


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of texts laid end to end; those of text r are ``hashes[first[r]:first[r + 1]]``."""
    inside = INSIDE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[edge] = inside[edge]
    start = np.flatnonzero(begin)
    return _hash_words(data, start, _TABLE), np.searchsorted(start, offsets)


@dataclass
class Block:
    """Some items: their ids, sorted distinct terms, and each item's term numbers."""

    ids: list
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray

    def matrix(self) -> np.ndarray:
        """Items by terms, 1 where the item has the term."""
        out = np.zeros((len(self.ids), len(self.vocabulary)))
        out[self.item, self.term] = 1
        return out


def blocks(items: DataFrame, key: str = "item_id", text: str = "text", max_items: int = BLOCK_ITEMS,
           max_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of bounded size, read one after the other; items without terms are in none."""
    def block(ids: list, sets: list[np.ndarray]) -> Block:
        vocabulary = np.unique(np.concatenate(sets))
        return Block(ids, vocabulary, np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.searchsorted(vocabulary, np.concatenate(sets)))

    ids, sets, size = [], [], 0
    for row in items.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).toLocalIterator():
        raw = np.frombuffer((row[1] or "").encode(), np.uint8)
        own = np.unique(terms(raw, np.array([0, len(raw)]))[0])
        if not len(own):
            continue
        if ids and (len(ids) == max_items or size + len(own) > max_terms):
            yield block(ids, sets)
            ids, sets, size = [], [], 0
        ids.append(row[0])
        sets.append(own)
        size += len(own)
    if ids:
        yield block(ids, sets)


def vectors(docs: DataFrame, vocabulary: Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and occurrences of the vocabulary's terms, of documents with a term."""
    src = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for i, j in spans(off, 1 << 20):
                found, first = terms(data[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.diff(first)
                at = np.searchsorted(known, found)
                hit = known[np.minimum(at, len(known) - 1)] == found
                pair, count = np.unique(np.repeat(np.arange(j - i), n)[hit] * len(known) + at[hit], return_counts=True)
                row, term = pair // len(known), pair % len(known)
                has = n > 0
                ends = np.concatenate(([0], np.searchsorted(row, np.flatnonzero(has), "right"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).filter(pa.array(has)), pa.array(n[has]),
                     pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(count, pa.int64()))],
                    names=["doc_id", "n", "terms", "counts"])
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, _VECTORS)


class Best:
    """The k best (score, key) of every item so far: highest score, then least key, null keys last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.key = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64)
        self.null = np.zeros((items, k), bool)

    def add(self, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        """Take in a tile of scores, items by documents; no tie is lost, whatever the order of the tiles."""
        k, (items, width) = self.k, score.shape
        last = self.score[:, -1:]
        fit = (score > 0) & (score >= last)
        if width > k:
            fit &= score >= np.partition(score, width - k, axis=1)[:, width - k, None]
        later = (null > self.null[:, -1:]) | ((null == self.null[:, -1:]) & (key >= self.key[:, -1:]))
        fit &= ~((score == last) & later)
        row, col = np.nonzero(fit)
        if not len(row):
            return
        touched = np.unique(row)
        held = self.score[touched] > 0
        who = np.concatenate((row, np.repeat(touched, k)[held.ravel()]))
        s = np.concatenate((score[row, col], self.score[touched][held]))
        d = np.concatenate((key[col], self.key[touched][held]))
        z = np.concatenate((null[col], self.null[touched][held]))
        order = np.lexsort((d, z, -s, who))
        who, s, d, z = who[order], s[order], d[order], z[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < k
        at = who[keep], place[keep]
        self.score[at], self.key[at], self.null[at] = s[keep], d[keep], z[keep]


def tile_scores(matrix: np.ndarray, weight: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray, m: np.ndarray,
                term_tile: int = TERM_TILE) -> np.ndarray:
    """Scores (items by documents, int64) of a tile of documents given as (row, term, count), ``m`` per row."""
    impact = weight[term] * ((1000000000 * count) // (1000 * count + 8 * m[row]))
    present, local = np.unique(term, return_inverse=True)
    largest = int(impact.max(initial=1))
    width = max(1, min(term_tile, ((1 << 53) - 1) // max(largest, 1)))
    out = np.zeros((len(matrix), len(m)), np.int64)
    order = np.argsort(local, kind="stable")
    for lo in range(0, len(present), width):
        some = order[np.searchsorted(local, lo, sorter=order):np.searchsorted(local, lo + width, sorter=order)]
        dense = np.zeros((min(width, len(present) - lo), len(m)))
        dense[local[some] - lo, row[some]] = impact[some]
        out += (matrix[:, present[lo:lo + width]] @ dense).astype(np.int64)
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of every term; a term that no document holds scores nothing anyway."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def _search_block(docs: DataFrame, block: Block, item_field: StructField, key: str, text: str, k: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(block.vocabulary)
    held = stage(vectors(docs, known, key, text), "vectors")
    known.destroy()
    n_docs, total = held.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    for term, x in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's vocabulary at most
        df[term] = x
    shared = sc.broadcast((block, term_weights(df, n_docs)))
    out = StructType([item_field, *StructType.fromDDL("_item int, doc_id long, score long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = shared.value
        matrix, best = own.matrix(), Best(len(own.ids), k)
        for batch in batches:
            keys = batch.column(0)
            null, key_ = keys.is_null().to_numpy(False), keys.fill_null(0).to_numpy()
            m = np.array([10 + 90 * x * n_docs // total for x in batch.column(1).to_pylist()], np.int64)
            for i in range(0, batch.num_rows, TILE):
                part = batch.column(2).slice(i, TILE)
                row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy(False))
                term, count = part.flatten().to_numpy(), batch.column(3).slice(i, TILE).flatten().to_numpy()
                best.add(tile_scores(matrix, weight, row, term, count, m[i:i + TILE]), key_[i:i + TILE], null[i:i + TILE])
        item, place = np.nonzero(best.score)
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.ids[x] for x in item]), pa.array(item, pa.int32()), pa.array(best.key[item, place], mask=best.null[item, place]),
                 pa.array(best.score[item, place])], names=out.names)

    some = held.mapInArrow(run, out)
    rank = F.row_number().over(Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select(item_field.name, "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = TOP, max_items: int = BLOCK_ITEMS, max_terms: int = BLOCK_TERMS) -> DataFrame:
    """item key, rank, doc_id and score of each item's k best documents."""
    spark, field = docs.sparkSession, items.select(item_key).schema[0]
    paths = []
    for block in blocks(items, item_key, item_text, max_items, max_terms):
        paths.append(stage_path(spark, "ranks"))
        _search_block(docs, block, field, key, text, k).write.parquet(paths[-1])
    schema = StructType([field, *StructType.fromDDL("rank int, doc_id long, score long")])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


_SQL_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH words AS (SELECT doc_id, unnest({_SQL_TERMS.format("text")}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM lens),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_SQL_TERMS.format("text")}) AS term FROM benchmark)),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN totals),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lens USING (doc_id) CROSS JOIN totals GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
