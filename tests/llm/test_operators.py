"""The training-data operators against brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF
from featurelane.llm import (attribution, binary_packing, chaining, components, compression, iblt, mixing, perspectives, ppm, pu_quality, queries, ship, stages,
                             vertical_join)
from featurelane.llm.tokens import BYTE_BPE
from featurelane.llm.words import Words, mix, text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i}" for i in range(9000))
ODD = [(1, None, "a"), (2, "", None), (3, "  \n\t", "a"), (4, "one two", "b"), (5, "one two", "b"), (6, " x 你好 \U0001f600 naïve <|endoftext|>", None),
       (7, LONG, "a"), (7, LONG, "a"), (None, "no key here at all", "c"), (9, "x" * 70000, "a"), (10, "1 2 3 ### !!", "a")]
SCHEMA = "doc_id long, text string, source string, lang string, n_words string, start int"


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame([(*r, "en", "clash", 1) for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_compression(spark, docs, odd):
    for table in (docs, odd):
        want = Counter((r.doc_id, *base_counts(r.text)) for r in table.select("doc_id", "text").collect())
        got = compression.compression_columns(table).collect()
        assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)
    noise = "".join(chr(33 + b % 90) + (" " if i % 9 == 8 else "") for i, b in enumerate(np.random.default_rng(1).integers(0, 90, 9000)))
    flat = "lorem " + "ab cd ef gh ij kl mn op qr st " * 400
    verdict = {r.doc_id: r.band_ok for r in compression.compression_columns(
        spark.createDataFrame([(1, noise), (2, flat)], "doc_id long, text string")).collect()}
    assert verdict == {1: False, 2: False}
    assert compression.quality_filter(odd).columns == odd.columns
    assert compression.compression_columns(empty(spark)).count() == 0


def test_chunk_verdicts(spark, docs):
    """Ratios, chunks up to the last byte and verdicts against a plain computation over whole texts."""
    r = np.random.default_rng(2)
    prose = " ".join(t.text for t in docs.where("lang = 'en' and n_chars between 500 and 3000").orderBy("doc_id").limit(20).collect())
    noise = "".join(map(chr, r.integers(33, 123, 20000)))
    made = [prose[:4096] + noise[:3000], prose[:5000], prose[:4096] + "z" * 3900, noise[:4096] + prose[:100], noise[:4096] + prose[:4096], prose[:4097],
            prose[:9000] + noise[:9300], "", prose[:8192]]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(made)], "doc_id long, text string"))
    packed = compression.zstandard.ZstdCompressor(level=compression.LEVEL, write_content_size=False, write_checksum=False).compress

    def fits(part):
        limits = [(lo, hi) for most, lo, hi in compression.BANDS if most is None or len(part) <= most][0]
        return limits[0] <= len(packed(part)) / len(part) <= limits[1]

    want = {}
    for d in table.collect():
        raw, parts = d.text.encode(), []
        while sum(map(len, parts)) < len(raw):
            parts.append(raw[sum(map(len, parts)):][:4096])
        bad = [p for p in parts if not fits(p)]
        want[d.doc_id] = (len(parts), len(bad), bool(raw) and fits(raw) and sum(map(len, bad)) * 2 <= len(raw))
    got = {r.doc_id: (r.n_chunks, r.n_bad_chunks, r.band_ok) for r in compression.compression_columns(table).collect()}
    assert got == want and got[-1][:2] == (2, 1) and got[-4] == (2, 1, False)


def test_packing_round_trip(spark, docs, odd):
    exact = Tokenizer.from_file(BYTE_BPE)  # as it is: an added token's string is that token
    for table in (docs, odd):
        rows = binary_packing.pack_documents(table).collect()
        assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 and r.length == 1 << r.bucket <= 2048 for r in rows)
        parts = defaultdict(dict)
        for r in rows:
            parts[r.doc_id].setdefault(r.start, r.ids)
        for r in table.select("doc_id", "text").collect():
            ids = exact.encode(r.text or "", add_special_tokens=False).ids + [1]
            assert b"".join(x for _, x in sorted(parts[r.doc_id].items())) == np.array(ids, "<u4").tobytes()
    assert binary_packing.pack_documents(empty(spark)).count() == 0
    assert [binary_packing.piece_lengths(n) for n in (1, 6, 2048, 5000)] == [[1], [4, 2], [2048], [2048, 2048, 512, 256, 128, 8]]


def test_added_tokens_are_as_the_library_gives_them(spark):
    ship(spark)
    exact = Tokenizer.from_file(BYTE_BPE)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "你<|endoftext|><|endoftext|> x", "<|endoftext", "no such token"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: b"" for r in docs.collect()}
    for r in sorted(binary_packing.pack_documents(docs).collect(), key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += r.ids
    assert got == {i: np.array(exact.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for i, t in enumerate(texts)}
    for rule in attribution.RULES:
        per = attribution.attribute_tokens(docs, rule=rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
        assert {r.doc_id: round(r.n) for r in per} == {i: len(exact.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_quality_takes_any_other_columns(spark):
    ship(spark)
    rows = [(i, ("good words here and there " if i % 2 else "### !! $$ ") * 5, True, i, 0.5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p boolean, _k long, x double")
    labels = spark.createDataFrame([(i, i % 2, "c") for i in range(40)], "doc_id long, quality int, p string")
    plain = {r.doc_id: r.score for r in pu_quality.score(docs.select("doc_id", "text"), labels.drop("p"), F.lit(True)).collect()}
    assert {r.doc_id: r.score for r in pu_quality.score(docs, labels, F.lit(True)).collect()} == plain and len(plain) == 40


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(spark, docs, odd, rule):
    exact = Tokenizer.from_file(BYTE_BPE)
    some = docs.where("doc_id < 40")
    got = defaultdict(dict)
    for r in attribution.attribute_tokens(some, rule=rule).collect():
        got[r.doc_id][r.section_id] = r
    for d in some.collect():
        e = exact.encode(d.text, add_special_tokens=False)
        stops = np.cumsum([len(x) for x in d.text.splitlines(keepends=True)]) if "\r" not in d.text else None
        assert sum(r.n_tokens for r in got[d.doc_id].values()) == pytest.approx(len(e.ids))
        if rule == "start" and stops is not None and d.text.isascii():
            assert Counter(int(np.searchsorted(stops, a, "right")) for a, _ in e.offsets) == {
                k: r.n_tokens for k, r in got[d.doc_id].items() if r.n_tokens}
    assert attribution.attribute_tokens(odd, rule=rule).where("n_tokens is null").count() == 0
    assert attribution.attribute_tokens(empty(spark), rule=rule).count() == 0
    sections = spark.createDataFrame([(4, 0, 0, 3), (4, 1, 2, 99), (4, 2, None, None), (88, 0, 0, 1)], "doc_id long, section_id long, start long, stop long")
    per = {r.section_id: r for r in attribution.attribute_tokens(odd.where("doc_id = 4"), sections, rule).collect()}
    assert per[0].stop == 3 and per[1].start == 3 and sum(r.n_tokens for r in per.values()) == 2
    whole, fields = attribution.join_fields(odd.where("doc_id = 4"), ["text", "source"])
    assert {r.section_id: r.n_tokens for r in attribution.attribute_tokens(whole, fields, "start").collect() if r.section_id is not None} == {0: 2, 1: 1}


def test_mixing(spark, docs, odd):
    for table in (docs, odd):
        plan = mixing.mix_plan(table).collect()
        again = mixing.mix_plan(table.repartition(7)).collect()
        assert sorted(map(repr, plan)) == sorted(map(repr, again))
        source_words, taken, most = Counter(), Counter(), Counter()
        for r in plan:
            source_words[r.source] += r.size * r.rows
            taken[r.source] += r.size * r.rows * r.copies
            most[r.source] = max(most[r.source], r.size * r.rows)
            assert 0 <= r.copies <= 3
        order = sorted(source_words, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        total, full = sum(source_words.values()), set()
        while True:  # the excess is reshared by weight until no target is above three times its source
            left = total - sum(3 * source_words[s] for s in full)
            goal = {s: 3 * source_words[s] if s in full else left * weight[s] / sum(weight[t] for t in order if t not in full) for s in order}
            new = {s for s in order if s not in full and goal[s] >= 3 * source_words[s]}
            if not new:
                break
            full |= new
            if full == set(order):
                goal = {s: 3 * source_words[s] for s in order}
                break
        for r in plan:
            assert r.target == pytest.approx(goal[r.source])
            assert abs(taken[r.source] - r.target) <= most[r.source] + 1
    assert mixing.mix_plan(empty(spark)).count() == 0
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixing.mix(docs).count() == sum(r.rows * r.copies for r in mixing.mix_plan(docs).collect())


def test_fold_keeps_expectation(spark):
    """Over many independent sources each document is taken in proportion to its mass."""
    units = spark.range(3000).selectExpr("concat('s', id div 3) source", "(id % 3 + 1) * 1000L size", "id", "(id % 3 + 1) * 400L mass")
    got = mixing.copies(units).join(units, "id").groupBy(F.expr("id % 3")).agg(F.avg("extra").alias("p")).collect()
    assert all(abs(r.p - 0.4) < 0.06 for r in got)


def test_mix_small_sources(spark):
    """Sources of 50 documents, one of which may hold a quarter of the words, come within 1 % of their targets."""
    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.01") + "/documents.parquet")
    got = mixing.mix_plan(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.expr("size * rows * copies")).alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.01 * r.target for r in got)


def test_large_documents_keep_expectation(spark):
    """One document of 52 %, one of 10 % and 38 small ones a source: each is taken in proportion to its mass, whatever the limit."""
    size = "CASE id % 40 WHEN 0 THEN 5200L WHEN 1 THEN 1000L ELSE 100L END"
    units = spark.range(40 * 400).selectExpr("concat('s', id div 40) source", f"{size} size", "id", f"{size} * 3 div 10 mass")
    for giant in (8, mixing.GIANT):
        got = mixing.copies(units, giant=giant).join(units, "id").groupBy("size").agg(F.avg("extra").alias("p"), F.count("extra").alias("n")).collect()
        assert sum(r.n for r in got) == 40 * 400 and all(abs(r.p - 0.3) < 0.08 for r in got)


def jaccard_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t, True)
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_vertical_join(spark, docs, texts, odd):
    want = jaccard_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in vertical_join.VerticalJoin(docs).components().collect()}
    assert got == want
    kept = vertical_join.keep_one(docs)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()} and kept.columns == docs.columns
    rows = {(r.doc_id, r.component_id) for r in vertical_join.VerticalJoin(odd).components().collect()}
    assert {(4, 4), (5, 4), (1, 1), (2, 2), (3, 3), (7, 7)} <= rows and (None, None) in rows
    assert vertical_join.VerticalJoin(empty(spark)).components().count() == 0
    assert vertical_join.keep_one(odd).count() == len(ODD) - 2


def test_vertical_join_edited_group(spark):
    """A group of edited copies round the threshold."""
    ship(spark)
    r = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = {}
    for d in range(90):
        w = list(base)
        for p in r.integers(0, 120, r.integers(0, 9)):
            w[p] = f"e{d}_{p}"
        rows[d] = " ".join(w)
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want = jaccard_components(rows)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in vertical_join.VerticalJoin(table).components().collect()} == want


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 24 partitions that are not coalesced."""
    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_links_need_no_shuffle(spark, many_partitions, monkeypatch):
    """Components of few links are found in single tasks, and are those found with shuffles."""
    r = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(12)]
    links = stages.stage(spark.createDataFrame(pairs, "u long, v long"), "links")
    root = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root}
    sc = spark.sparkContext
    sc.setJobGroup("few links", "")
    got = [tuple(x) for x in components.components(links).collect()]
    jobs = sc.statusTracker().getJobIdsForGroup("few links")
    sc.setLocalProperty("spark.jobGroup.id", None)
    tasks = [i.numTasks for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds if (i := sc.statusTracker().getStageInfo(s))]
    assert len(got) == len(want) and set(got) == want
    assert tasks and max(tasks) < 24
    monkeypatch.setattr(components, "few", lambda staged: staged)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = [tuple(x) for x in components.components(links).collect()]
    assert len(got) == len(want) and set(got) == want


def test_bitmap_is_gathered_by_few_tasks(spark, many_partitions):
    """However many shuffle partitions there are, the tasks that gather its 128 packs are bounded; every value is marked."""
    ship(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    hashes = spark.range(500).select(F.xxhash64("id").alias("hash"))
    sc = spark.sparkContext
    sc.setJobGroup("bitmap", "")
    marked = stages.bitmap(hashes, "hash")
    jobs = sc.statusTracker().getJobIdsForGroup("bitmap")
    sc.setLocalProperty("spark.jobGroup.id", None)
    tasks = [i.numTasks for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds if (i := sc.statusTracker().getStageInfo(s))]
    assert tasks and max(tasks) <= 32
    assert marked.has(np.array([r.hash for r in hashes.collect()])).all()


def test_few_is_bounded(spark):
    """By rows and by the bytes of a payload; null payloads count as nothing."""
    staged = stages.stage(spark.range(100).repartition(4).select("id", F.when(F.col("id") > 0, F.lit(b"x" * 10)).alias("b")), "few")
    parts = lambda df: df.select(F.spark_partition_id()).distinct().count()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert parts(staged) > 1 and parts(stages.few(staged, 99)) > 1
        assert parts(stages.few(staged, 100)) == 1 and parts(stages.few(staged, 100, "b")) == 1
        stages.FEW_BYTES, held = 989, stages.FEW_BYTES
        try:
            assert parts(stages.few(staged, 100, "b")) > 1
        finally:
            stages.FEW_BYTES = held
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_vertical_join_with_shuffles(spark, monkeypatch):
    """What is too large for one task gives the same components."""
    ship(spark)
    for module in (components, vertical_join):
        monkeypatch.setattr(module, "few", lambda staged, *limits, **payload: staged)
    test_vertical_join_edited_group(spark)


def test_vertical_join_many_groups(spark):
    """Families whose members share n-grams in all degrees, so that runs of common n-grams of many pairs are left for the last step."""
    ship(spark)
    r = np.random.default_rng(11)
    rows = {}
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(int(r.integers(20, 150)))]
        for _ in range(25):
            w = list(base)
            for p in r.integers(0, len(w), int(len(w) * r.uniform(0, 0.12))):
                w[p] = f"e{int(r.integers(0, 40))}"
            rows[len(rows)] = " ".join(w[int(r.integers(0, 4)):])
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    want = jaccard_components(rows)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in vertical_join.VerticalJoin(table).components().collect()} == want
    assert 20 < len({c for _, c in want.values()}) < len(rows) - 20


def test_keep_one_with_repeated_ids(spark):
    """Near copies under one doc_id leave one row, other texts under it stay; columns may be maps."""
    ship(spark)
    base = [f"k{i}" for i in range(80)]
    near, other = " ".join([*base[:79], "changed"]), " ".join(f"o{i}" for i in range(60))
    rows = [(1, " ".join(base), {"a": 1}), (1, near, {"a": 2}), (1, other, {"b": 3}), (2, other, {"b": 4}), (2, " ".join(base), None),
            (3, "", {}), (3, "", {}), (4, None, {}), (None, near, {}), (5, "alone", {"x": 1}), (5, "alone", {"x": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    for parts in (1, 4):
        got = vertical_join.keep_one(docs.repartition(parts)).collect()
        assert sorted((r.doc_id, r.text == other) for r in got if r.doc_id in (1, 2)) == [(1, False), (1, True)]
        assert Counter(r.doc_id for r in got) == {1: 2, 3: 1, 4: 1, 5: 1}


def test_signatures_never_drop_a_link():
    """The bound is never below the overlap, also where the bitmaps differ in size, and drops most of what does not link."""
    r = np.random.default_rng(9)
    dropped = 0
    for n in [1, 2, 3, 15, 16, 17, 31, 60, 64, 65, 500, 1024, 1025, 5000] * 6:
        x = r.integers(0, 2**64, n, dtype=np.uint64)
        gone = int(r.integers(0, n + 1))
        y = np.concatenate([x[gone:], r.integers(0, 2**64, int(r.integers(0, n // 4 + 2)), dtype=np.uint64)])
        if not len(y):
            continue
        sides = [np.frombuffer(vertical_join.signature(z), np.uint8) for z in (x, y)]
        bound, real = vertical_join.overlap_bound(*sides, len(x), len(y)), len(np.intersect1d(x, y))
        assert real <= bound <= min(len(x), len(y))
        dropped += 100 * bound < 80 * (len(x) + len(y) - bound)
    assert dropped > 40


def test_pairs_that_no_hub_joins(spark, monkeypatch):
    """Where groups overlap, the pairs left after the hubs' rounds complete the components of all pairs."""
    ship(spark)
    rest, left = vertical_join.VerticalJoin._rest, []

    def counted(self, lists, tested):
        left.append(rest(self, lists, tested).count())
        return rest(self, lists, tested)

    monkeypatch.setattr(vertical_join.VerticalJoin, "_rest", counted)
    rng = random.Random(4)
    base = [[f"b{i}_{j}" if rng.random() < 0.5 else f"c{rng.randrange(60)}" for j in range(rng.randrange(10, 60))] for i in range(6)]
    rows = []
    for i in range(120):
        t = list(rng.choice(base))
        if rng.random() < 0.4:
            t = t[:rng.randrange(1, len(t) + 1)] + rng.choice(base)[rng.randrange(5):]
        for _ in range(rng.randrange(max(1, len(t) // 6))):
            t[rng.randrange(len(t))] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(t)))
    sets = [{tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} for w in (x.split() for _, x in rows)]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if v == b else v for v in root]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in vertical_join.VerticalJoin(table, k=2, threshold=60).components().collect()}
    assert got == dict(enumerate(root)) and sum(left) > 10 and 10 < len(set(root)) < 110


def test_passages(spark, odd):
    ship(spark)
    r = np.random.default_rng(3)

    def fresh(n):
        return [f"f{x}" for x in r.integers(0, 10**9, n)]

    passage = fresh(70)
    fuzzy = list(passage)
    fuzzy[20], fuzzy[50] = "other", "thing"
    rows = [(1, " ".join(fresh(40) + passage + fresh(30))), (2, " ".join(fresh(200))), (3, " ".join(fresh(9) + passage + fresh(5))),
            (4, " ".join(fresh(60) + fuzzy)), (5, " ".join(passage[:30] + fresh(80))), (6, None), (7, "")]
    table = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, n_chars long")
    found = {x.doc_id: x for x in chaining.passages(table).collect()}
    assert set(found) == {3, 4}
    assert (found[3].start, found[3].n_words, found[3].other_id, found[3].other_start, found[3].n_equal) == (9, 70, 1, 40, 70)
    assert (found[4].start, found[4].n_words, found[4].other_id) == (60, 70, 1) and found[4].n_equal == 68
    left = {x.doc_id: x for x in chaining.remove_passages(table, chaining.passages(table)).collect()}
    assert set(left) == {1, 2, 3, 4, 5, 6, 7} and left[1].text == rows[0][1] and left[6].text is None
    assert words(left[3].text) == words(rows[2][1])[:9] + words(rows[2][1])[79:] and left[3].n_chars == len(left[3].text)
    assert chaining.passages(empty(spark)).count() == 0
    assert {x.doc_id for x in chaining.passages(odd).collect()} == set()


def test_passages_of_unlike_rows(spark):
    """Rows of one doc_id keep their own passages, and each row loses its own words only."""
    rng = random.Random(5)
    def free(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]
    p, q = free(70), free(60)
    rows = [(1, free(30) + p + free(9)), (2, free(200) + p + free(20)), (2, free(300)), (2, free(40) + q), (3, q + free(90)), (3, free(100)), (3, free(11) + p)]
    table = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string").repartition(3)
    got = chaining.passages(table)
    assert sorted((x.doc_id, x.start, x.n_words, x.other_id, x.other_start) for x in got.collect()) == [
        (2, 200, 70, 1, 30), (3, 0, 60, 2, 40), (3, 11, 70, 1, 30)]
    want = [rows[0], (2, rows[1][1][:200] + rows[1][1][270:]), rows[2], rows[3], (3, rows[4][1][60:]), rows[5], (3, rows[6][1][:11])]
    left = [(x.doc_id, x.text.split()) for x in chaining.remove_passages(table, got).collect()]
    assert sorted(left) == sorted(want)


def test_chain_is_best():
    """The Fenwick chain equals the quadratic one."""
    r = np.random.default_rng(2)
    for _ in range(40):
        n = int(r.integers(2, 25))
        x, y, length = r.integers(0, 80, n), r.integers(0, 80, n), r.integers(1, 6, n)
        best = [0.0] * n
        for i in sorted(range(n), key=lambda i: (x[i], y[i])):
            gains = [best[j] - 0.125 * (x[i] - x[j] - length[j] + y[i] - y[j] - length[j]) for j in range(n)
                     if j != i and x[j] + length[j] <= x[i] and y[j] + length[j] <= y[i]]
            best[i] = length[i] + max([0.0, *gains])
        c = chaining.chain(x, y, length, max_gap=10**6)[0]
        score = sum(int(length[i]) for i in c) - 0.125 * sum(
            x[b] - x[a] - length[a] + y[b] - y[a] - length[a] for a, b in zip(c, c[1:]))
        assert score == pytest.approx(max(best))


def test_stretches_are_all_maximal_ranges():
    """The ranges equal those of a quadratic search."""
    def brute(aligned, least, share):
        n = len(aligned)
        good = [(i, j) for i in range(n) for j in range(i + least, n + 1)
                if aligned[i] and aligned[j - 1] and sum(aligned[i:j]) * 100 >= share * (j - i)]
        return [(i, j) for i, j in good if not any(a <= i and j <= b and (a, b) != (i, j) for a, b in good)]

    def runs(*lengths):
        return np.concatenate([np.full(n, i % 2 == 0) for i, n in enumerate(lengths)])

    assert chaining.stretches(runs(45, 12, 45)) == [(0, 102)] and chaining.stretches(runs(49, 1, 3)) == [(0, 53)]
    assert chaining.stretches(runs(0, 4, 70, 9)) == [(4, 74)] and chaining.stretches(runs(3, 10, 50, 10, 3)) == [(0, 63), (13, 76)]
    assert chaining.stretches(np.zeros(90, bool)) == [] == chaining.stretches(runs(49, 1)) == chaining.stretches(runs(0))
    r = np.random.default_rng(3)
    for _ in range(300):
        aligned = r.random(int(r.integers(1, 60))) < r.choice([0.5, 0.75, 0.8, 0.9])
        assert chaining.stretches(aligned, 10, 0.8) == brute(aligned.tolist(), 10, 80)


def planted(share, n, seed):
    """Copies of ``n`` fresh passages of 100 words in which the share of words stays, by the way in which the others change."""
    r, rows, wanted = np.random.default_rng(seed), [], {}

    def fresh(k):
        return [f"w{v}" for v in r.integers(0, 10**9, k)]

    for way in ("every", "random", "gaps"):
        for i in range(n):
            first, copy = 2 * len(wanted), 2 * len(wanted) + 1
            passage, edits = fresh(100), round(100 * (1 - share))
            at = np.linspace(0, 100, edits, endpoint=False).astype(int) + 2 if way == "every" else r.choice(np.arange(3, 97), edits, replace=False)
            edited = {int(a): [] if way == "gaps" and a % 2 else fresh(2 if way == "gaps" else 1) for a in at}
            text = [v for j, w in enumerate(passage) for v in edited.get(j, [w])]
            rows += [(first, " ".join(fresh(30) + passage + fresh(30))), (copy, " ".join(fresh(40) + text + fresh(20)))]
            wanted[copy] = (way, first, 40, len(text))
    return rows, wanted


def recall(table, wanted):
    """The share of passages of which half of the words or more are found, by way."""
    hit = defaultdict(set)
    for x in chaining.passages(table).collect():
        if x.doc_id in wanted and x.other_id == wanted[x.doc_id][1]:
            assert x.n_words >= 50 and x.n_equal >= 0.8 * x.n_words
            hit[x.doc_id] |= set(range(x.start, x.start + x.n_words))
    got = defaultdict(list)
    for d, (way, _, start, n) in wanted.items():
        got[way].append(len(hit[d] & set(range(start, start + n))) >= n / 2)
    return {way: float(np.mean(v)) for way, v in got.items()}


@pytest.mark.parametrize("share, least", [(0.82, 0.5), (0.875, 0.95), (0.95, 1.0)])
def test_fuzzy_passages_are_found(spark, share, least):
    """Evenly changed words are always found; else the share found is as good as the identity is above the limit."""
    ship(spark)
    rows, wanted = planted(share, 20, 7)
    got = recall(spark.createDataFrame(rows, "doc_id long, text string"), wanted)
    assert got["every"] == 1.0 and got["random"] >= least, got


def test_no_exact_passage_is_missed(spark):
    """On a table of shared lines, all runs of 50 words that an earlier document holds lie in passages."""
    ship(spark)
    r = np.random.default_rng(11)
    lines = [[f"l{i}x{j}" for j in range(30)] for i in range(12)] + [["same"] * 40]
    a, b = lines[0], lines[1]
    rows = [(1, a + ["p"] * 9), (2, ["q"] * 9 + b), (3, a + b), (4, a + b)]
    rows += [(5 + i, [w for k in r.choice(13, int(r.integers(1, 6))) for w in lines[k][int(r.integers(0, 2)):]]) for i in range(200)]
    found = defaultdict(set)
    for x in chaining.passages(spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")).collect():
        found[x.doc_id] |= set(range(x.start, x.start + x.n_words))
    held, n = {}, 0
    for d, t in rows:
        for i in range(len(t) - 49):
            if held.setdefault(tuple(t[i:i + 50]), d) < d:
                n += 1
                assert found[d] >= set(range(i, i + 50)), (d, i)
    assert n > 500 and found[4] == set(range(60))


def test_passages_whose_lines_other_documents_hold(spark):
    """A fuzzy copy is found however many documents hold its lines before the first one and between the two."""
    ship(spark)
    r = np.random.default_rng(13)

    def fresh(k):
        return [f"w{v}" for v in r.integers(0, 10**9, k)]

    passage = fresh(80)
    copy = [fresh(1)[0] if i % 10 == 9 else w for i, w in enumerate(passage)]
    lines = [passage[10 * i:10 * i + 9] for i in range(8)]
    rows = [(i, fresh(90) + line + fresh(90)) for i, line in enumerate(lines)] + [(8, fresh(20) + passage + fresh(30))]
    rows += [(9 + i, fresh(90) + line + fresh(90)) for i, line in enumerate(lines)] + [(17, fresh(30) + copy + fresh(20))]
    got = chaining.passages(spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")).collect()
    assert [(x.doc_id, x.start, x.n_words, x.other_id, x.other_start, x.n_equal) for x in got] == [(17, 30, 79, 8, 20, 72)]


@pytest.mark.parametrize("hot", [3, 4096])
def test_every_holder_is_matched(spark, monkeypatch, hot):
    """The runs between the first and last matches are those of all matches of all pairs of documents, with seeds in one group or dealt into blocks."""
    ship(spark)
    monkeypatch.setattr(chaining, "HOT", hot)
    monkeypatch.setattr(chaining, "CELLS", 50)
    r = np.random.default_rng(14)
    lines = [[f"l{i}x{j}" for j in range(int(r.integers(3, 12)))] for i in range(9)] + [["same"] * 9]
    rows = [(int(d), [w for k in r.choice(10, int(r.integers(1, 7))) for w in lines[k][int(r.integers(0, 2)):]]) for d in range(40)]
    rows += [(3, lines[2] + lines[4] + ["other"]), (11, lines[9] + lines[0])]  # rows that repeat a doc_id
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string").repartition(3)
    unlike = chaining._unlike(docs)
    tags = {(x.doc_id, x.text): x.th if x.doc_id in (3, 11) else 0 for x in chaining._marked(docs).collect()}
    held = defaultdict(list)
    for d, t in rows:
        for i in range(len(t) - 3):
            held[tuple(t[i:i + 4])].append((d, tags[d, " ".join(t)] << 32 | i))
    wanted = defaultdict(list)
    for places in held.values():
        for d, x in places:
            for o, y in places:
                if o < d:
                    wanted[d, o].append((x, y))
    wanted = {k: Counter(zip(*(z.tolist() for z in chaining.diagonals(*(np.array(u) for u in zip(*v)))))) for k, v in wanted.items()}
    got = defaultdict(list)
    for x in chaining.seed_matches(docs, unlike).collect():
        m = np.frombuffer(x.m, "<i8" if x.wide else "<u4").astype(np.int64).reshape(-1, 2)
        got[x.doc_id, x.other_id] += [(a & ~(1 << 31), b, bool(a >> 31 & 1)) for a, b in m.tolist()]
    runs = {k: chaining.runs_of(np.zeros(len(v), int), *(np.array(u) for u in zip(*v)))[1:] for k, v in got.items()}
    assert {k: Counter(zip(*(z.tolist() for z in v))) for k, v in runs.items()} == wanted and len(wanted) > 300


def test_holders_across_batches():
    """Cutting the sorted seeds into batches changes no match."""
    r = np.random.default_rng(5)
    rows = sorted({(int(s), int(d), int(p)) for s, d, p in zip(r.integers(0, 9, 300), r.integers(0, 12, 300), r.integers(0, 50, 300))})
    first, last, wanted = {}, defaultdict(dict), Counter()
    for s, d, p in rows:
        hub = first.setdefault(s, (d, p))
        if hub[0] != d:
            wanted[(d, *hub[:1], p, hub[1], bool(s & 1))] += 1
            before = max(e for e in last[s] if e < d)
            if before != hub[0] and not s & 1:
                wanted[(d, before, p, last[s][before], False)] += 1
        last[s][d] = p
    table = pa.table({"seed": pa.array([x[0] for x in rows]), "doc_id": pa.array([x[1] for x in rows]),
                      "pos": pa.array([x[2] for x in rows], pa.int32())})
    for size in (1, 2, 7, 1000):
        got = pa.Table.from_batches(chaining.holders(iter(table.to_batches(size))))
        assert Counter(tuple(x.values()) for x in got.to_pylist()) == wanted


def test_bitmap_of_made_values(spark):
    """Values that a function makes of the batches are marked in one Python step before the shuffle."""
    def double(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(0).to_numpy() * 2)], names=["v"])

    bits = stages.bitmap(spark.range(0, 500, 1, 3), "v", 16, double)
    assert bits.has(np.arange(2000)).tolist() == [v % 2 == 0 and v < 1000 for v in range(2000)]


def test_chains_side_by_side(monkeypatch):
    """Rows chained side by side give the chains that each gives alone, down to the least number of words."""
    r = np.random.default_rng(7)
    row, x, y, n, wanted = [], [], [], [], set()
    for i in range(120):
        k = int(r.integers(1, 40))
        at = np.sort(r.choice(200, k, replace=False))
        to, size = np.where(r.random(k) < 0.6, at + 5, r.integers(0, 200, k)), r.integers(1, 9, k)
        for c in chaining.chain(at, to, size):
            if size[c].sum() >= 20:
                wanted.add(tuple(len(row) + j for j in c))
        row, x, y, n = row + [i] * k, [*x, *at], [*y, *to], [*n, *size]
    row, x, y, n = (np.array(v) for v in (row, x, y, n))
    for most in (256, 12):
        monkeypatch.setattr(chaining, "AT_ONCE", most)
        got = {tuple(c) for c in chaining.long_chains(row, x, y, n, 20) if n[c].sum() >= 20}
        assert got == wanted and len(got) > 50


def test_rows_align_alike_alone_and_together():
    r = np.random.default_rng(8)
    a, b, shift = [], [], []
    for _ in range(60):
        one = r.integers(0, int(r.choice([6, 40, 5000])), int(r.integers(1, 200))).astype(np.uint64)
        two = np.delete(one, r.integers(0, len(one), 3))
        two[r.integers(0, len(two), 4) if len(two) else []] = 9999
        a.append(one)
        b.append(np.concatenate([r.integers(0, 6, 7).astype(np.uint64), two]))
        shift.append(7)

    def aligned(rows):
        ends = [np.cumsum([0, *(len(side[i]) for i in rows)]) for side in (a, b)]
        found = chaining.align(np.concatenate([a[i] for i in rows]), ends[0], np.concatenate([b[i] for i in rows]), ends[1],
                               np.array([shift[i] for i in rows]))
        return sorted((rows[int(z[0])], *map(int, z[1:])) for z in zip(*found))

    together = aligned(range(60))
    assert together == sorted(z for i in range(60) for z in aligned([i])) and len({z[0] for z in together}) > 20
    for i, s, k, t, equal in together:
        assert 50 <= k and s + k <= len(a[i]) and 0.8 * k <= equal <= np.isin(a[i][s:s + k], b[i]).sum()


@pytest.mark.parametrize("tag", [0, 1 << 40])
def test_matches_of_a_pair_across_batches(monkeypatch, tag):
    """However the matches are held back and cut into batches, a pair's chains are those of all its matches."""
    r = np.random.default_rng(9)
    monkeypatch.setattr(chaining, "HELD_MATCHES", 50)
    seeds = []
    for s in range(80):  # a line of 80 words in all documents at different places, and some seeds of MIN_WORDS words
        seeds += [(2 * s, d, 7 * d + s + tag * (d % 2)) for d in range(6)]
    for s in range(31):
        seeds += [(1001 + 2 * s, d, 7 * d + s + tag * (d % 2)) for d in (1, 4)]
    seeds += [(int(s), int(d), int(p)) for s, d, p in zip(2 * r.integers(100, 130, 300), r.integers(0, 6, 300), r.integers(100, 900, 300))]
    seeds = sorted(set(seeds))
    table = pa.table({"seed": [x[0] for x in seeds], "doc_id": [x[1] for x in seeds], "pos": [x[2] for x in seeds]})
    pairs = defaultdict(list)
    for x in pa.Table.from_batches(chaining.holders(iter(table.to_batches()))).to_pylist():
        pairs[x["doc_id"], x["other_id"]].append((x["pos"], x["y"], x["whole"]))
    wanted = Counter()
    for (d, o), m in pairs.items():
        x, y, whole = (np.array(v) for v in zip(*m))
        wanted.update((d, o, *c) for c in chaining.seed_chains(x, y, whole))
    held = pa.Table.from_batches(chaining.pairs_held(iter(table.to_batches(40)))).sort_by([("doc_id", "ascending"), ("other_id", "ascending")])
    for size in (1, 3, 1000):
        got = pa.Table.from_batches(chaining.chains_in_order(iter(held.to_batches(size))))
        assert Counter(tuple(x.values()) for x in got.to_pylist()) == wanted and len(wanted) > 5


def test_common_words_between_blocks():
    r = np.random.default_rng(6)
    for _ in range(60):
        a, b = r.integers(0, 4, int(r.integers(0, 9))), r.integers(0, 4, int(r.integers(0, 9)))
        got = chaining.common(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(p < q and s < t for (p, s), (q, t) in zip(got, got[1:]))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in np.ndindex(len(a), len(b)):
            best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (a[i] == b[j]))
        assert len(got) == (best[-1, -1] if len(a) != len(b) else (a == b).sum())


def test_fingerprints(spark, docs, texts, odd):
    def ends(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return mix(Words(raw, np.array([0, len(raw)])).hash)[0] % 8 == 0

    def pieces(t):
        out = Counter()
        for line in t.split("\n"):
            piece = []
            for w in words(line):
                piece.append(w)
                if ends(w):
                    out[tuple(piece)] += 1
                    piece = []
            out[tuple(piece)] += bool(piece)
        return out

    def like(a, b):
        a, b = pieces(a), pieces(b)
        return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0

    got = {r.doc_id: r for r in iblt.compare_next(docs).collect()}
    order = sorted(texts)
    for d, nxt in zip(order, order[1:] + order[:1]):
        t, u, r = texts[d], texts[nxt], got[d]
        edited = t[:len(t) - len(t) // 4] + u[:len(t) // 4]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(like(t, edited)) and r.near_next == pytest.approx(like(t, u))
        told = iblt.compare(r.fingerprint, r.edited_fingerprint)
        assert told is None or (told[0], len(told[1]), len(told[2])) == (pytest.approx(r.near_edited), r.n_removed, r.n_added)
    by_text = defaultdict(set)
    for d in order:
        by_text[texts[d]].add(got[d].fingerprint)
    assert all(len(x) == 1 for x in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)
    assert iblt.compare_next(odd).count() == len(ODD) and iblt.compare_next(empty(spark)).count() == 0


def test_fingerprints_compare_alone():
    """Stored fingerprints, of different sizes too, give the differing digests without the texts, or say that they cannot."""
    def sketch(*texts):
        data, off = text_bytes(pa.array(texts))
        digest, at = iblt.paragraphs(data, off)
        m = iblt.sketch_size(np.diff(at))
        cells = iblt.sketches(digest, np.ones(len(digest), np.int64), np.repeat(np.arange(len(m)), np.diff(at)), m)
        return iblt.fingerprints(cells[:3], m), [set(digest[i:j].tolist()) for i, j in zip(at, at[1:])]

    line = [f"w{i}" for i in range(4000)]
    texts = [" ".join(line), " ".join(["new"] + line), " ".join(line[:1990] + ["x", "y"] + line[2000:]), " ".join(line[:3500]),
             " ".join(line + [f"v{i}" for i in range(200)]), "", " ".join(line[:60]), "other words altogether"]
    prints, sets = sketch(*texts)
    told = 0
    for i, j in itertools.product(range(len(texts)), repeat=2):
        got = iblt.compare(prints[i], prints[j])
        if got is not None:
            told += 1
            likeness, a, b = got
            assert set(a.tolist()) == sets[i] - sets[j] and set(b.tolist()) == sets[j] - sets[i]
            both = sets[i] | sets[j]
            assert likeness == pytest.approx(len(sets[i] & sets[j]) / len(both) if both else 1.0)
    assert iblt.compare(prints[0], prints[1])[0] > 0.99 and iblt.compare(prints[0], prints[2])[0] > 0.98  # one word put in front
    assert iblt.compare(prints[0], prints[5]) is None and told >= len(texts) + 10


def test_language(spark, docs, odd):
    got = queries.op6_ppm_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    pred = {r.doc_id: (r.lang_pred, r.score) for r in ppm.identify(odd, F.lit(True)).collect()}
    assert pred[1] == pred[2] == pred[3] == pred[10][:1] + pred[1][1:] == ("und", 0.0) and pred[4][0] == "en"
    assert {r.lang_pred for r in ppm.identify(odd, F.lit(False)).collect()} == {"und"}
    assert ppm.identify(empty(spark), F.lit(True)).count() == 0


def test_code_lengths_by_hand():
    """One context chain: the longest known context codes the byte, unknown ones cost their escapes."""
    data = np.frombuffer(b"ababab", np.uint8)
    x, at = ppm.padded(data, np.array([0, 6]), 32)
    grams, n = np.unique((x[at - 3] << 24) | (x[at - 2] << 16) | (x[at - 1] << 8) | x[at], return_counts=True)
    m = ppm.build(["x"], np.ones(1), np.zeros(len(grams), int), grams, n)
    bits = ppm.code_bits(m, np.frombuffer(b"ab", np.uint8), np.array([0, 2]))[0, 0]
    # "   " saw a once (1 of 2), "  a" saw b once (1 of 2)
    assert bits == pytest.approx(2.0)
    bits = ppm.code_bits(m, np.frombuffer(b"b", np.uint8), np.array([0, 1]))[0, 0]
    # escapes of the three contexts of blanks (1/2 each), then b in order 0: 3 of 6 + 2
    assert bits == pytest.approx(3 - np.log2(3 / 8))


def test_perspectives(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    res = con.execute(perspectives.ORACLE)
    names = [d[0] for d in res.description]
    got = queries.op7_perspective_rotation(spark, SF).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, res.fetchall()))
    turns = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, 2, None, "x"), (None, 0, "cy", "q"), (2, 0, "system", "s")],
                                  "conv_id long, turn long, role string, text string")
    rows = perspectives.rotate(turns).collect()
    assert Counter((r.conv_id, r.perspective) for r in rows) == {(1, "ann"): 4, (1, "bob"): 4, (None, "cy"): 1}
    ann = sorted((r for r in rows if r.perspective == "ann"), key=lambda r: r.start)
    whole = "".join(r.segment for r in ann)
    assert [whole[r.mask_start:r.mask_stop] for r in ann if r.mask_start is not None] == ["hi<|im_end|>\n"]
    assert perspectives.rotate(turns.where("false")).count() == 0


def test_pu_quality(spark, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op8_pu_quality(spark, SF.replace("0.001", "0.01")).join(
        spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    nothing = labels.where("false")
    assert {r.score for r in pu_quality.score(odd, nothing, F.lit(True)).collect()} == {0.5}
    some = spark.createDataFrame([(4, 1), (7, 0), (7, None), (99, 1)], "doc_id long, quality int")
    scores = [r.score for r in pu_quality.score(odd, some, F.lit(True)).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert pu_quality.score(empty(spark), some, F.lit(True)).count() == 0


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_is_estimated_from_the_scores(share):
    r = np.random.default_rng(4)
    positive, n = r.normal(0, 1, (3000, 18)), int(3000 * share)
    unlabelled = r.permutation(np.concatenate([r.normal(0, 1, (n, 18)), r.normal(1.5, 1, (3000 - n, 18))]))
    assert abs(pu_quality.estimate_prior(positive, unlabelled) - share) < 0.08


def test_quality_sees_words(spark):
    """Two classes of one shape that differ in their words alone."""
    ship(spark)
    r = np.random.default_rng(3)
    good, bad = ([" ".join(f"{kind}{v:03d}" for v in r.integers(0, 60, 80)) for _ in range(400)] for kind in ("abc", "xyz"))
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string").repartition(4)
    some = spark.createDataFrame([(i, 1) for i in range(0, 400, 2)], "doc_id long, quality int")
    got = {x.doc_id: x.score for x in pu_quality.score(table, some, F.lit(True)).collect()}
    assert min(got[i] for i in range(1, 400, 2)) > max(got[i] for i in range(400, 800))


def test_non_negative_risk_and_gradient():
    """One step of the fit goes along the naive risk's numerical gradient, and backwards where the negatives' risk is below 0."""
    r = np.random.default_rng(2)
    p, u = r.normal(0.3, 1, (30, 4)), r.normal(-0.2, 1, (40, 4))
    model = pu_quality.fit(p, u, 0.5, rounds=0)
    dp, du = model.design(p), model.design(u)

    def parts(weights, prior):
        plus = np.mean([np.log1p(np.exp(-(d @ weights))) for d in dp])
        minus_p, minus_u = (np.mean([np.log1p(np.exp(d @ weights)) for d in rows]) for rows in (dp, du))
        return prior * plus, minus_u - prior * minus_p

    for prior, clipped in ((0.5, False), (1.5, True)):  # at zero weights the negatives' risk is (1 - prior) * log 2
        at = np.zeros(len(model.weights))
        assert (parts(at, prior)[1] < 0) == clipped
        risk = (lambda w: -parts(w, prior)[1]) if clipped else (lambda w: sum(parts(w, prior)))
        slope = np.array([(risk(at + h) - risk(at - h)) / 2e-5 for h in 1e-5 * np.eye(len(at))])
        step = pu_quality.fit(p, u, prior, rounds=1).weights  # Adam's first step is the rate along the gradient's signs
        sure = np.abs(slope) > 1e-4
        assert sure.sum() >= 6 and (np.sign(step[sure]) == -np.sign(slope[sure])).all()


def test_few_positives_reach_the_fit(spark):
    """Trusted positives only, on 1 of 100 documents, with a sample of all that holds hardly one of them."""
    ship(spark)
    r = np.random.default_rng(9)
    good = [" ".join(f"word{v}" for v in r.integers(0, 3000, int(r.integers(60, 200)))) + "." for _ in range(1000)]
    bad = ["# | 12 ## <> 99 " * int(r.integers(5, 40)) for _ in range(1000)]
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string").repartition(4)
    some = spark.createDataFrame([(50 * i, 1) for i in range(20)] + [(10**6 + i, 1) for i in range(4000)], "doc_id long, quality int")
    model, prior = pu_quality.train(table, some, F.lit(True), sample=60)
    assert model is not None and 0.3 < prior < 0.75
    got = {x.doc_id: x.score for x in pu_quality.score(table, some, F.lit(True), sample=60).collect()}
    assert np.mean([got[i] >= 0.5 for i in range(1000)]) > 0.9 and np.mean([got[i] < 0.5 for i in range(1000, 2000)]) > 0.9


def test_pipeline(spark, docs, texts):
    """Every stage against what it says of its own input."""
    kept = {i for i, t in texts.items() if (c := base_counts(t))[0] >= 10 and 100 * c[4] <= 20 * c[0]}
    table, seen = docs, []
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, table, SF).cache()
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.collect()}
        if name == "quality_rules":
            assert ids <= kept and len(ids) > 0.95 * len(kept)
        elif name == "ngram_join":
            assert ids == {c for _, c in jaccard_components({r.doc_id: r.text for r in table.collect()}).values()}
        elif name == "substring_dedup":
            first = {}
            for r in after.orderBy("doc_id").collect():
                w = words(r.text, True)
                for j in range(len(w) - 49):
                    assert first.setdefault(tuple(w[j:j + 50]), r.doc_id) == r.doc_id
        table = after
        seen.append(name)
    assert corpus_pipeline.STAGES[-1][1](spark, table, SF).agg(F.sum("length")).first()[0] > 0
    assert seen == ["quality_rules", "ngram_join", "substring_dedup", "mix_sources"]


def test_components_take_few_rounds(spark, monkeypatch):
    """Links that are stars already are one round; repeated links, chains and loops give the least node reachable."""
    from featurelane.llm import components as module
    rounds = []
    monkeypatch.setattr(module, "stage", lambda df, name, old=module.stage: rounds.append(name) or old(df, name))
    stars = [(10 * h + i, 10 * h) for h in range(3) for i in range(1, 9)]
    got = {x.node: x.root for x in module.components(spark.createDataFrame(stars + stars[:5], "u long, v long")).collect()}
    assert got == {n: n // 10 * 10 for s in stars for n in s} and rounds == ["stars"]
    r = random.Random(3)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    rows = module.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {x.node: x.root for x in rows} == {n: find(n) for n in root} and len(rows) == len(root)
    assert module.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bitmap_marks_values_and_no_others(spark):
    """With one shuffle; values may repeat."""
    ship(spark)
    marked = np.random.default_rng(4).integers(-2**63, 2**63, 5000)
    table = spark.createDataFrame([(int(v),) for v in [*marked, *marked[:99]]], "v long").repartition(5)
    bits = stages.bitmap(table, "v", 26)
    others = np.random.default_rng(5).integers(-2**63, 2**63, 5000)
    slots = set((marked & (1 << 26) - 1).tolist())
    assert bits.has(marked).all() and bits.has(others).tolist() == [x in slots for x in (others & (1 << 26) - 1).tolist()]
    assert not stages.bitmap(table.where("false"), "v").has(marked).any()
