"""N-gram Jaccard join by vertical partitioning, and its connected components.

Two texts link when the sets of their k-word shingles have Jaccard similarity of at least
``threshold`` percent.  The steps, each a Spark job over narrow rows:

1. *Global order.*  All shingles are counted in a table of 2**20 counters (fixed size, summed
   through a tree of tasks).  The order is by counter, then hash: rare n-grams first.  Any
   total order gives the same links; this one keeps frequent n-grams out of the prefixes.
2. *Prefixes.*  Two linked sets share one of their first ``n - ceil(t n) + 1`` n-grams.
   Prefix n-grams are counted, and only those seen twice or more are looked at again.
3. *Representatives.*  Equal sets are one node, whatever their number.
4. *Vertical partitioning.*  The global order is cut into ``FRAGMENTS`` ranges of equal mass and every
   set that may link is cut accordingly.  A candidate pair's overlap is counted
   in each fragment separately and summed per pair; the exact test follows.  Pairs whose signatures
   (a bitmap of each set, a sixteenth of its size or so) already show too many n-grams that the other set lacks
   are dropped before; that bound never drops a link.
5. *Candidates without all pairs.*  In the list of nodes that share a prefix n-gram, every
   node is first paired with one hub only.  Links found merge nodes into components.  In later
   rounds only nodes outside the hub's component are left, with a hub of their own; when a
   round finds no more links or no longer halves what is left, every remaining pair of different components that shares a prefix
   n-gram is counted, with one row for each run of n-grams that both have one after the other and not for each n-gram.
   A pair inside one component needs no test: it changes no component.
   So a group of a million near copies costs about a million tests, no link between
   components is lost, and nothing is capped.

Hot n-grams and hot nodes are combined before shuffles or joined by sort-merge joins, which adaptive
execution splits; shingles are recomputed from the texts instead of being stored (they are
larger than the texts).  Hashes have 64 bits; see ``words``.

Results by case: a null or empty text, or one without words, has no shingles, links with
nothing and is its own component; fewer than k words make one shingle; rows whose doc_id
repeats, or is null, are separate rows (component_id is the least non-null doc_id of the
component); an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.llm.components import components
from featurelane.llm.stages import Bitmap, bitmap, few, id_hash, stage
from featurelane.llm.words import U, mix, row_blocks, shingle_set

K = 5
THRESHOLD = 80
LOG2_COUNTERS = 20
FRAGMENTS = 8
_SLICE = 14  # 2**14 counters a slice
#: Pairs that one task tests rather than a shuffle.
_FEW_PAIRS = 1 << 13


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum counter slices that arrive in this task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(blob.as_buffer(), np.int64)
            total[s] = total[s] + part if s in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["s", "x"])


def order_of(docs: DataFrame, k: int, log2_counters: int = LOG2_COUNTERS) -> np.ndarray:
    """Place of each counter's n-grams in the global order (cumulated mass before them), and the total."""
    n = 1 << log2_counters
    width = min(n, 1 << _SLICE)

    def count(batches):
        table = np.zeros(n, np.int64)
        for _, w in row_blocks(batches, "text", True):
            found = [shingle_set(w.of(r), k) for r in range(len(w.first) - 1)]
            table += np.bincount((np.concatenate(found) & U(n - 1)).astype(np.int64), minlength=n)
        if table.any():
            for s in range(n // width):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()),
                                                  pa.array([table[s * width:(s + 1) * width].tobytes()], pa.binary())],
                                                 names=["s", "x"])

    schema = "s int, x binary"
    parts = docs.select("text").mapInArrow(count, schema)
    # at most 16 partial sums of a slice reach the second level, whatever the number of tasks
    first = (parts.withColumn("t", F.spark_partition_id() % 16).repartition("s", "t").coalesce(64).drop("t")
             .mapInArrow(_add_slices, schema))
    table = np.zeros(n, np.int64)
    for s, blob in first.repartition("s").coalesce(16).mapInArrow(_add_slices, schema).collect():  # n / width rows: fixed size
        table[s * width:(s + 1) * width] = np.frombuffer(blob, np.int64)
    order = np.lexsort((np.arange(n), table))
    place = np.empty(n + 1, np.int64)
    place[order] = np.cumsum(table[order]) - table[order]
    place[n] = table.sum()
    return place


def _ordered(shingles: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the global order, and the places."""
    at = place[(shingles & U(len(place) - 2)).astype(np.int64)]
    order = np.lexsort((shingles, at))
    return shingles[order], at[order]


def _node(shingles: np.ndarray) -> np.int64:
    """64-bit identity of a set."""
    with np.errstate(over="ignore"):
        total = mix(shingles).sum(dtype=U) + U(len(shingles)) * U(0x9E3779B97F4A7C15)
    return mix(np.array([total], U)).view(np.int64)[0]


def signature(shingles: np.ndarray) -> bytes:
    """Bitmap of a set's n-grams by their low bits, four to eight bits for each n-gram."""
    m = max(8, 1 << int(4 * len(shingles) - 1).bit_length())
    bits = np.zeros(m, bool)
    bits[(shingles & U(m - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def overlap_bound(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int) -> int:
    """The most that two sets can share: a bit of one alone stands for an n-gram that the other lacks."""
    bits_x, bits_y = (np.unpackbits(b).astype(bool) for b in (x, y))
    m = min(len(bits_x), len(bits_y))  # powers of two: the longer bitmap folds onto the shorter
    bits_x, bits_y = (b.reshape(-1, m).any(axis=0) for b in (bits_x, bits_y))
    return min(n_x - int((bits_x & ~bits_y).sum()), n_y - int((bits_y & ~bits_x).sum()))


def prefix_length(n: int, threshold: int) -> int:
    """First n-grams of a set of n, of which linked sets share one at least."""
    return n - -(-n * threshold // 100) + 1


class VerticalJoin:
    """Links, classes and components of ``docs`` (columns key and text)."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, threshold: int = THRESHOLD,
                 log2_counters: int = LOG2_COUNTERS, fragments: int = FRAGMENTS):
        self.k, self.threshold, self.fragments = k, threshold, fragments
        self.docs = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
        self.docs = self.docs.withColumn("row", id_hash("text"))
        self.place = docs.sparkSession.sparkContext.broadcast(order_of(self.docs, k, log2_counters))  # 8 MB

    def _repeated_prefix_ngrams(self) -> Bitmap:
        place, k, threshold = self.place, self.k, self.threshold

        def prefixes(batches):
            for _, w in row_blocks(batches, "text", True):
                found = [np.zeros(0, U)]
                for r in range(len(w.first) - 1):
                    s = shingle_set(w.of(r), k)
                    if len(s):
                        found.append(_ordered(s, place.value)[0][:prefix_length(len(s), threshold)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["hash"])

        twice = self.docs.select("text").mapInArrow(prefixes, "hash long").groupBy("hash").count().where("count > 1")
        return bitmap(twice, "hash")

    def profile(self) -> DataFrame:
        """doc_id, row (hash of the text), n_shingles, node (null without shingles) and the prefix n-grams that may be shared, staged."""
        place, k, threshold, repeated = self.place, self.k, self.threshold, self._repeated_prefix_ngrams()

        def run(batches):
            for batch, w in row_blocks(batches, "text", True):
                size, node, hashes, places, count = [], [], [], [], [0]
                for r in range(len(w.first) - 1):
                    s = shingle_set(w.of(r), k)
                    size.append(len(s))
                    node.append(int(_node(s)) if len(s) else None)
                    p = _ordered(s, place.value)[0][:prefix_length(len(s), threshold)] if len(s) else s
                    hit = np.flatnonzero(repeated.has(p)) if len(s) else np.zeros(0, np.int64)
                    hashes.append(p[hit].view(np.int64))
                    places.append(hit.astype(np.int32))
                    count.append(count[-1] + len(hit))
                offsets = pa.array(count, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hashes), pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places), pa.int32()))],
                    names=["doc_id", "row", "n_shingles", "node", "hashes", "places"])

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        found = stage(self.docs.mapInArrow(run, f"doc_id {kind}, row long, n_shingles long, node long, hashes array<long>, places array<int>"),
                      "profile")
        repeated.free()
        return found

    def _signatures(self, members: DataFrame) -> DataFrame:
        """(node, segment): the signatures of the sets of the nodes in ``members`` (node column, may repeat), staged.

        A node may come more than once (another row with the same key and text).
        """
        k, wanted = self.k, bitmap(members, "node")

        def run(batches):
            for batch, w in row_blocks(batches, "text", True, only=lambda b: wanted.has(b.column(1).to_numpy())):
                sets = [signature(shingle_set(w.of(r), k)) for r in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sets, pa.binary())], names=["node", "segment"])

        found = stage(self.docs.select("text", F.xxhash64("doc_id", "row").alias("node")).mapInArrow(run, "node long, segment binary"),
                      "signatures")
        wanted.free()
        return found

    def _segments(self, members: DataFrame) -> DataFrame:
        """(node, frag, segment): the sets of the nodes in ``members`` (node column, may repeat), cut by fragment, staged.

        A node may come more than once (another row with the same key and text).
        """
        place, k, fragments, wanted = self.place, self.k, self.fragments, bitmap(members, "node")

        def run(batches):
            for batch, w in row_blocks(batches, "text", True, only=lambda b: wanted.has(b.column(1).to_numpy())):
                node, frag, segment = [], [], []
                for r, name in enumerate(batch.column(1).to_pylist()):
                    s = shingle_set(w.of(r), k)
                    if not len(s):
                        continue
                    s, at = _ordered(s, place.value)
                    part = at * fragments // max(1, int(place.value[-1]))
                    cut = np.searchsorted(part, np.arange(fragments + 1))
                    for f in range(fragments):
                        if cut[f] < cut[f + 1]:
                            node.append(name)
                            frag.append(f)
                            segment.append(np.sort(s[cut[f]:cut[f + 1]]).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(frag, pa.int32()),
                                                  pa.array(segment, pa.binary())], names=["node", "frag", "segment"])

        found = stage(self.docs.select("text", F.xxhash64("doc_id", "row").alias("node")).mapInArrow(run, "node long, frag int, segment binary"),
                      "segments")
        wanted.free()
        return found

    @staticmethod
    def _dealt(pairs: DataFrame, segments: DataFrame, *by: str) -> DataFrame:
        """The pairs (a, b, n_a, n_b) with both sides' segments (sa, sb), a row for each of ``by`` that both have.

        The segments move once to the pairs of their node, and once more with the pair.
        """
        group = ("a", "b", "n_a", "n_b", *by)
        ends = pairs.select("a", "b", "n_a", "n_b", F.explode(F.array("a", "b")).alias("node"))
        dealt = ends.join(segments, "node").groupBy(*group).agg(
            F.max(F.when(F.col("node") == F.col("a"), F.col("segment"))).alias("sa"),
            F.max(F.when(F.col("node") == F.col("b"), F.col("segment"))).alias("sb"))
        return dealt.where("sa is not null and sb is not null").select(*group, "sa", "sb")

    def _near(self, pairs: DataFrame, signatures: DataFrame) -> DataFrame:
        """The pairs that can link by their signatures, staged; no linked pair is missing."""
        threshold = self.threshold

        def fits(batches):
            for batch in batches:
                n_a, n_b = (batch.column(i).to_pylist() for i in (2, 3))
                most = [overlap_bound(*(np.frombuffer(z.as_buffer(), np.uint8) for z in (x, y)), n, m)
                        for x, y, n, m in zip(batch.column(4), batch.column(5), n_a, n_b)]
                keep = [100 * c >= threshold * (n + m - c) for c, n, m in zip(most, n_a, n_b)]
                yield batch.select([0, 1, 2, 3]).filter(pa.array(keep, pa.bool_()))

        return stage(self._dealt(pairs, signatures).mapInArrow(fits, "a long, b long, n_a long, n_b long"), "near")

    def _linked(self, pairs: DataFrame, segments: DataFrame) -> DataFrame:
        """The pairs (a, b, n_a, n_b) that link: partial overlaps by fragment, summed per pair."""
        def overlap(batches):
            for batch in batches:
                n = [len(np.intersect1d(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), True))
                     for x, y in zip(batch.column(5), batch.column(6))]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(n, pa.int64())],
                                                 names=["a", "b", "n_a", "n_b", "frag", "part"])

        once = self._dealt(pairs, segments, "frag").mapInArrow(overlap, "a long, b long, n_a long, n_b long, frag int, part long")
        summed = once.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
        return summed.where(f"100 * overlap >= {self.threshold} * (n_a + n_b - overlap)").select(
            F.col("a").alias("u"), F.col("b").alias("v"), "overlap")

    def _size_ok(self) -> str:
        return f"100 * n_a >= {self.threshold} * n_b and 100 * n_b >= {self.threshold} * n_a"

    def _needed(self) -> str:
        """Least overlap of a linked pair, times (100 + threshold)."""
        return f"{self.threshold} * (n_a + n_b)"

    def _star(self, lists: DataFrame) -> DataFrame:
        """Each node of a list with the list's hub; ``lists`` has it in a struct.

        The hub is the node with the fewest rarer n-grams before this one: of a text and its edited
        copies that is the text itself, which is nearer to them than they are to each other.
        """
        t = 100 + self.threshold
        return (lists.where("node <> hub.node")
                .select(F.col("node").alias("a"), F.col("hub.node").alias("b"), F.col("n").alias("n_a"), F.col("hub.n").alias("n_b"),
                        F.col("place").alias("i"), F.col("hub.place").alias("j"))
                .where(self._size_ok())
                .where(f"{t} * (least(i, j) + 1 + least(n_a - 1 - i, n_b - 1 - j)) >= {self._needed()}")
                .where(f"{t} * (least(n_a, n_b) - if(n_a <= n_b, i, j)) >= {2 * self.threshold} * least(n_a, n_b)")
                .select("a", "b", "n_a", "n_b").distinct())

    @staticmethod
    def _placed(lists: DataFrame) -> DataFrame:
        """The open postings with their number among the node's open n-grams in the global order, and the one before.

        A node's window holds the prefix n-grams of one text.
        """
        w = Window.partitionBy("node").orderBy("place", "hash")
        return lists.withColumns({"q": F.row_number().over(w) - 1, "prev": F.lag("hash").over(w)})

    def _meetings(self, lists: DataFrame, minors: DataFrame) -> DataFrame:
        """The runs of prefix n-grams that two nodes of different components share, by their first n-gram, as far as it leaves room for a link.

        Of n-grams that follow each other among both nodes' open ones only the first makes a row, so the first common one
        always does.  That one lies within the first ``n - ceil(2 t n / (1 + t)) + 1`` of the smaller set if the pair links, and of the
        n-grams before any common one only the open ones can be common.
        """
        t, sides = self.threshold, ("node", "n", "place", "comp", "q", "prev")
        x = minors.select("hash", *[F.col(c).alias(f"{c}_x") for c in sides])
        y = lists.select("hash", *[F.col(c).alias(f"{c}_y") for c in sides])
        fits = F.expr(f"comp_x <> comp_y and 100 * n_y >= {t} * n_x and 100 * n_x >= {t} * n_y"
                      f" and coalesce(prev_x <> prev_y, true)"
                      f" and {100 + t} * (least(q_x, q_y) + 1 + least(n_x - 1 - place_x, n_y - 1 - place_y)) >= {t} * (n_x + n_y)"
                      f" and {100 + t} * (least(n_x, n_y) - if(n_x <= n_y, place_x, place_y)) >= {2 * t} * least(n_x, n_y)")
        return x.withColumnRenamed("hash", "_h").join(y, (F.col("_h") == F.col("hash")) & fits).drop("_h")

    def _rest(self, lists: DataFrame, tested: DataFrame) -> DataFrame:
        """All pairs of different components that share a prefix n-gram, can link and were not tested; ``lists`` has the hubs."""
        placed = stage(self._placed(lists), "placed")
        swap = "node_x < node_y"
        met = self._meetings(placed, placed.where("comp <> hub.comp")).select(
            F.greatest("node_x", "node_y").alias("a"), F.least("node_x", "node_y").alias("b"),
            *[F.expr(f"if({swap}, {c}_y, {c}_x)").alias(a) for c, a in (("n", "n_a"), ("place", "i"))],
            *[F.expr(f"if({swap}, {c}_x, {c}_y)").alias(b) for c, b in (("n", "n_b"), ("place", "j"))])
        # nothing is common before the first common n-gram
        near = (met.groupBy("a", "b", "n_a", "n_b").agg(F.min("i").alias("i"), F.min("j").alias("j"))
                .where(f"{100 + self.threshold} * (1 + least(n_a - 1 - i, n_b - 1 - j)) >= {self._needed()}").select("a", "b", "n_a", "n_b"))
        return near.join(tested, ["a", "b"], "left_anti")

    @staticmethod
    def _first() -> list[Column]:
        """Of a class of equal sets: its least doc_id (null last, the least text hash of that) and, by these, its node's name among the links."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        return [first.getField("doc_id").alias("least_id"), F.xxhash64(first.getField("doc_id"), first.getField("row")).alias("name")]

    def classes(self, profile: DataFrame) -> DataFrame:
        """One row per distinct set: node (the name of its first document, by which that is found again), size and shared prefix n-grams."""
        return profile.where("node is not null").groupBy(F.col("node").alias("set")).agg(
            *self._first(), F.first("n_shingles").alias("n"), F.first("hashes").alias("hashes"),
            F.first("places").alias("places")).select(F.col("name").alias("node"), "n", "hashes", "places")

    def _labelled(self, nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
        """The nodes with their component so far."""
        if roots is None:
            return nodes.withColumn("comp", F.col("node"))
        return nodes.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")

    def _lists(self, labelled: DataFrame, part: int = 1) -> DataFrame:
        """The postings (hash, node, n, place, comp) of n-grams whose nodes lie in several components, with the hub.

        Open n-grams are found by an aggregate of (hash, component) alone; only their postings are moved.
        ``part``: of the n-grams, those whose hash divides by it.
        """
        grams = labelled.select("comp", F.explode("hashes").alias("hash")).where(F.col("hash") % part == 0)
        still = grams.groupBy("hash").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("hash")
        marked = bitmap(still, "hash")
        posted = (labelled.select("node", "n", "comp", F.explode(F.arrays_zip("hashes", "places")).alias("p"))
                  .select(F.col("p.hashes").alias("hash"), "node", "n", F.col("p.places").alias("place"), "comp")
                  .where(F.col("hash") % part == 0).where(marked.column(F.col("hash"))))
        return self._with_hub(few(stage(posted, "postings")))

    @staticmethod
    def _with_hub(posted: DataFrame) -> DataFrame:
        """Postings of the n-grams that several components share, with the hub and the list's length k."""
        hubs = posted.groupBy("hash").agg(
            F.min(F.struct("place", "node", "n", "comp")).alias("hub"), F.count(F.lit(1)).alias("k"),
            F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").drop("_lo", "_hi")
        return posted.join(hubs, "hash")

    @staticmethod
    def _cross_pairs(lists: DataFrame) -> int:
        """At most so many pairs of a node outside its hub's component with any node of the list."""
        return lists.where("comp <> hub.comp").agg(F.sum("k")).first()[0] or 0

    def _test(self, pairs: DataFrame) -> DataFrame:
        """The links among pairs: their nodes' first documents are read again, for the signatures and, where needed, whole sets."""
        def members(chosen: DataFrame) -> DataFrame:
            return chosen.select(F.explode(F.array("a", "b")).alias("node"))

        near = self._near(few(pairs, _FEW_PAIRS), few(self._signatures(members(pairs)), payload="segment"))
        return stage(self._linked(few(near, _FEW_PAIRS), few(self._segments(members(near)), payload="segment")), "linked")

    def links(self, profile: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """Links (u, v, overlap) between nodes that give the components, and these (node, root); None if there are none."""
        nodes = stage(self.classes(profile), "classes")
        found, tested, roots, part = None, None, None, 8
        # first with an eighth of the n-grams, which joins most of each group, then with all that are still open
        lists = self._lists(self._labelled(nodes, roots), part)
        while True:
            pairs = stage(self._star(lists), "pairs")
            some = not pairs.isEmpty()
            if some:
                new = self._test(pairs)
                tested = pairs if tested is None else tested.union(pairs)
                some = not new.isEmpty()
            if some:
                found = new if found is None else found.union(new)
                roots = few(stage(components(found), "roots"))
            if part > 1:
                part = 1
                all_lists = lists = few(stage(self._lists(self._labelled(nodes, roots)), "lists"))
                cross = self._cross_pairs(all_lists)
                if not cross:
                    break
                continue
            if not some:
                break
            relabelled = self._labelled(all_lists.select("hash", "node", "n", "place"), roots)
            all_lists = few(stage(self._with_hub(relabelled), "lists"))
            # the nodes of each list outside the component of its hub meet a hub of their own next
            outside = self._labelled(lists.select("hash", "node", "n", "place", "hub"), roots).where("node <> hub.node")
            hub = roots.select(F.col("node").alias("_h"), F.col("root").alias("_r"))
            outside = (outside.join(hub, F.col("hub.node") == F.col("_h"), "left")
                       .where("comp <> coalesce(_r, hub.node)").select("hash", "node", "n", "place", "comp"))
            lists = few(stage(self._with_hub(outside), "outside"))
            cross, before = self._cross_pairs(all_lists), cross
            if not cross or 2 * cross > before:
                break
        # no star finds another link, or stars gain little: now all pairs across components, none tested twice
        if all_lists.where("comp <> hub.comp").isEmpty():
            return found, roots
        flat = pairs.limit(0) if tested is None else tested
        flat = flat.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        rest = stage(self._rest(all_lists, flat), "rest")
        if rest.isEmpty():
            return found, roots
        new = self._test(rest)
        if new.isEmpty():
            return found, roots
        found = new if found is None else found.union(new)
        return found, few(stage(components(found), "roots"))

    def members(self) -> DataFrame:
        """doc_id, row, n_shingles, root (one for each component; null without shingles) and component_id of every row."""
        profile = self.profile()
        _, roots = self.links(profile)
        self.place.destroy()  # all that used it is staged
        least = few(stage(profile.where("node is not null").groupBy("node").agg(*self._first()), "least"))
        if roots is not None:
            joined = least.join(roots.withColumnRenamed("node", "name"), "name")
            of_root = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
            moved = roots.join(of_root, "root").select(F.col("node").alias("name"), "root", "component_id")
            least = least.join(moved, "name", "left").select("node", F.coalesce("root", "name").alias("root"),
                                                             F.coalesce("component_id", "least_id").alias("least_id"))
        else:
            least = least.select("node", F.col("name").alias("root"), "least_id")
        return profile.select("doc_id", "row", "n_shingles", "node").join(least, "node", "left").select(
            "doc_id", "row", "n_shingles", "root", F.coalesce("least_id", "doc_id").alias("component_id"))

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row of the documents."""
        return self.members().select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of its least key (null last), of several texts with this key the one of least hash.

    Of rows with equal key and text one stays, also where they have no shingles; which one depends on the rows' contents alone.
    Only rows that may go (a bitmap test on key and text) meet the exact join; all others pass straight through.
    """
    rows = few(stage(VerticalJoin(docs, key, text, **options).members(), "members"))
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)])
    k, t = (f"_{names.index(c)}" for c in (key, text))
    plain = plain.withColumns({"_row": F.xxhash64(F.col(t).cast("string")), "_id": F.xxhash64(k, F.xxhash64(F.col(t).cast("string")))})
    first = rows.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    per = rows.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("_n"), F.max("root").alias("root")).join(first, "root", "left")
    stays = F.col("root").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("row").eqNullSafe(F.col("first.row")))
    change = stage(per.select(F.col("doc_id").alias("_key"), F.col("row").alias("_row2"), "_n", stays.alias("_stay"),
                              F.xxhash64("doc_id", "row").alias("_id2")).where("_n > 1 or not _stay"), "leaving")
    marked = bitmap(change, "_id2")
    hit = marked.column(F.col("_id"))
    met = F.col(k).eqNullSafe(F.col("_key")) & (F.col("_row") == F.col("_row2"))
    judged = plain.where(hit).join(change, met, "left").where("_n is null or _stay")
    kept = [f"_{i}" for i in range(len(names))]
    whole = F.struct(*kept)
    once = (judged.where("_n > 1").groupBy("_key", "_row2").agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in kept]))
    out = plain.where(~hit).select(*kept).unionByName(judged.where("_n is null").select(*kept)).unionByName(once)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)])
