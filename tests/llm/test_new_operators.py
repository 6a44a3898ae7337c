"""Ranked search, sum-of-squares packing and the Merkle manifest against brute force and exact round trips."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from featurelane.llm import lexical, merkle, queries, ship, sum_of_squares
from featurelane.llm.tokens import BYTE_BPE

LONG = " ".join(f"w{i}" for i in range(9000))
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, rank string, score string, h int, idx int, piece string, length string, _row int"
ODD = [(1, None, "a", "x", 3), (2, "", None, None, None), (3, "  \n\t", "a", "", 0), (4, "one two", "b", "x", 7), (5, "one two", "b", "x", 7),
       (6, " x 你好 \U0001f600 naïve ÀB", None, None, 1), (7, LONG, "a", "x", 2**40), (7, LONG, "a", "x", 2**40), (7, "other two", "a", "x", 9),
       (8, "a <|endoftext|> two", "a", "z", 1), (None, "no key here at all two", "c", "x", 1), (9, "x" * 70000, "a", "z", 70000), (10, "1 2 3 ### !! One", "a", "z", 5)]
ITEMS = [(1, "one two THREE"), (1, "one two THREE"), (2, None), (3, ""), (4, "zzz nowhere"), (None, "two naïve你好"), (5, "à"), (6, LONG), (7, "##")]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame([(*r, "clash", "clash", 1, 2, "clash", "clash", 3) for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, doc_id string")


def same_as_sql(spark, name, order):
    got = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE[name]}) ORDER BY {order}").fetchall()
    assert len(want) and [tuple(r) for r in got.orderBy(*order.split(", ")).collect()] == want


def terms(text):
    low = (text or "").translate({65 + i: 97 + i for i in range(26)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k):
    bags = [(key, Counter(terms(text))) for key, text in docs]
    bags = [(key, bag, sum(bag.values())) for key, bag in bags if bag]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        wanted, found = set(terms(text)), []
        for key, bag, n in bags:
            m = 10 + 90 * n * n_docs // total
            score = sum(w[t] * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in wanted if t in bag)
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("bounds", [{}, {"max_items": 2, "max_terms": 3}, {"k": 2}])
def test_search_odd_rows(spark, odd, items, bounds):
    rows = [r[:2] for r in ODD]
    got = lexical.search(odd, items, **bounds)
    assert Counter(tuple(r) for r in got.collect()) == brute_search(rows, ITEMS, bounds.get("k", 10))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_ties_and_blocks(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(["a", "b", "c", "dd", "ee", "ff"], rng.integers(1, 6)))) for i in range(900)]
    wanted = [(i, " ".join(rng.choice(["a", "b", "c", "dd", "ee", "ff", "gg"], 3))) for i in range(30)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = lexical.search(table, spark.createDataFrame(wanted, "item_id long, text string"), max_items=7)
    assert Counter(tuple(r) for r in got.collect()) == brute_search(docs, wanted, 10)


def test_search_empty(spark, odd, items):
    assert lexical.search(odd.where("false"), items).count() == 0
    assert lexical.search(odd, items.where("false")).count() == 0
    assert lexical.search(odd.where("doc_id < 4"), items).count() == 0


def test_search_sql(spark):
    same_as_sql(spark, "op11_blocked_search", "item_id, rank")


def test_tile_sums_stay_exact():
    """Impacts near the bound are cut into tiles whose float64 sums are exact, whatever the tile width."""
    rng = np.random.default_rng(5)
    v, d = 300, 7
    weight = rng.integers(2**31, 2**32, v)
    row, term = np.repeat(np.arange(d), v), np.tile(np.arange(v), d)
    count, m = rng.integers(1, 2**20, v * d), rng.integers(10, 2**30, d)
    matrix = (rng.random((5, v)) < 0.5).astype(float)
    impact = weight[term] * ((1000000000 * count) // (1000 * count + 8 * m[row]))
    want = [[sum(int(x) for x, t, r in zip(impact, term, row) if r == j and matrix[i, t]) for j in range(d)] for i in range(5)]
    for width in (1, 7, 2048):
        assert lexical.tile_scores(matrix, weight, row, term, count, m, width).tolist() == want


def test_best_keeps_every_tie():
    rng = np.random.default_rng(7)
    score, key = rng.integers(0, 4, (6, 400)), rng.permutation(400) // 2
    null = rng.random(400) < 0.1
    for cut in (1, 13, 400):
        best = lexical.Best(6, 10)
        for i in range(0, 400, cut):
            best.add(score[:, i:i + cut], key[i:i + cut], null[i:i + cut])
        for q in range(6):
            want = sorted((-s, z, k) for s, k, z in zip(score[q].tolist(), key.tolist(), null.tolist()) if s)[:10]
            assert list(zip((-best.score[q]).tolist(), best.null[q].tolist(), best.key[q].tolist())) == want


def check_packing(rows, texts, capacity):
    """Every id once and in place, sequences gapless and within capacity."""
    exact = Tokenizer.from_file(BYTE_BPE)
    want = Counter((key, tuple(exact.encode(text or "", add_special_tokens=False).ids + [2])) for key, text in texts)
    by_sequence, pieces = defaultdict(list), Counter()
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.piece, r.start, r.ids] += 1
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for (key, ids), times in want.items():
        cuts = [0] if len(ids) % capacity else []
        cuts += range(len(ids) % capacity, len(ids), capacity)
        for k, a in enumerate(cuts):
            b = cuts[k + 1] if k + 1 < len(cuts) else len(ids)
            expected[key, k, a, np.array(ids[a:b], "<u4").tobytes()] += times
    assert pieces == expected
    return len(by_sequence)


def test_packing_round_trip(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd):
        texts = [tuple(r) for r in table.select("doc_id", "text").collect()]
        packed = sum_of_squares.pack_pieces(sum_of_squares.encode_pieces(table))
        rows = packed.collect()
        used = check_packing(rows, texts, 1024)
        assert used <= 1 + 1.05 * sum(r.length for r in rows) / 1024
        whole = {r.sequence_id: r for r in sum_of_squares.sequences(packed).collect()}
        assert sum(r.length for r in whole.values()) == sum(r.length for r in rows) and len(whole) == used
        for r in rows:
            assert whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)] == r.ids
    small = sum_of_squares.pack_pieces(sum_of_squares.encode_pieces(odd, max_length=16), capacity=16, per_packer=3)
    check_packing(small.collect(), [r[:2] for r in ODD], 16)
    assert sum_of_squares.pack_pieces(sum_of_squares.encode_pieces(odd.where("false"))).count() == 0


def test_packing_query(spark):
    rows = queries.QUERIES["op12_sum_of_squares"](spark, SF).collect()
    pieces = sum_of_squares.encode_pieces(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(
        (r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in pieces)


def test_place_takes_the_least_sum_of_squares():
    """Each placement against all choices written out: no open sequence that fits gives a smaller sum."""
    rng = np.random.default_rng(11)
    lengths = np.sort(rng.integers(1, 21, 400))[::-1]
    number, offset = sum_of_squares.place(lengths, 20)
    left: dict[int, int] = {}
    for n, seq, at in zip(lengths.tolist(), number.tolist(), offset.tolist()):
        def squares(to):
            gaps = Counter(g - n if s == to else g for s, g in left.items())
            gaps[0] = 0
            return sum(x * x for x in gaps.values())
        fits = [s for s, g in left.items() if g >= n]
        if fits:
            assert seq in fits and squares(seq) == min(map(squares, fits))
        else:
            assert seq not in left
            left[seq] = 20
        assert at == 20 - left[seq]
        left[seq] -= n
    assert len(left) <= 1 + 1.03 * lengths.sum() / 20


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, arity):
    """(key, leaf, subroot, root, proof, folded) of every row, by plain lists."""
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, plus=0):
        n = r["n_chars"] if r["n_chars"] is None else r["n_chars"] + plus
        return h(*[enc(x) for x in (r["doc_id"], r["source"], r["lang"], n, r["text"])])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            lo = i - i % arity
            out.append((level[lo:i], level[i + 1:lo + arity]))
            i //= arity
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[(r["lang"] is not None, (r["lang"] or "").encode())].append(r)
    order = sorted(groups)
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]])
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, j)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, 1 if hit else 0)
            for before, after in steps:
                node = h(*before, node, *after)
            proof = h(*[x for before, after in steps for x in before + after])
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_brute_force(spark, odd, arity):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    altered = {"n_chars": F.col("n_chars") + 1}
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    for table in (docs.withColumn("lang", F.when(F.col("doc_id") != 0, F.col("lang"))), odd, odd.where("doc_id = 4")):
        rows = [r.asDict() for r in table.collect()]
        got = merkle.manifest(table, arity=arity, altered=altered, where=where).drop("path")
        assert Counter(tuple(r) for r in got.collect()) == brute_manifest(rows, arity)


def test_manifest_empty_and_bad(spark, odd):
    assert merkle.manifest(odd.where("false")).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(odd, arity=1)
    whole = merkle.manifest(odd)
    assert whole.where("not verified").count() == 0


def test_manifest_sql(spark):
    same_as_sql(spark, "op13_sibling_shift_manifest", "doc_id")
