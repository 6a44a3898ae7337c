"""Mixing sources to target weights by pivotal dependent rounding, DataFrame operations only.

``targets`` shares the total size among the sources by weight; a target stops at ``max_repeat`` times
its source's size and the excess is reshared by weight until none is above.  A document of a source is
then due ``target / source size`` copies: the whole part is taken, the fraction is rounded.

Rounding each fraction alone would make a source's total vary with the square root of its documents.
Pivotal rounding pairs two open fractions and moves words from one to the other, at random but
with unchanged expectations, until one of them is 0 or 1; the other goes on.  The words that a pair takes
stay the same, so a source's total is off by its last open document at most:

* a document of more than 1/``GIANT`` of its source's open words (there are fewer than ``GIANT``) is paired with all smaller
  ones at once, the largest first: it is decided, and the rest of the source shares what it gives or takes in
  proportion, so that a large document is made good by many small ones and never left for the end;
* the others are grouped by source, size class (eight per octave) and hash into blocks of about
  ``BLOCK``; each block is one fold and leaves one open document at most;
* those of ``BLOCK`` blocks of a class meet in the next block, and so on up (a tree of logarithmic
  depth), then those of all classes of a source; the last one, of 1/``GIANT`` of the words at most, is rounded alone.

Sources of any size take the same path.

Words are integers in units of 2**-20, so mass is exact; the draws are hashes of the ids, so reruns
agree.  A hot source is many blocks; nothing is collected beyond a block.

Results by case: a null or empty text has size 0; a source of size 0 has target 0 and its documents no copies; a
null source is a source, the last; rows of equal doc_id, source and size are decided together; an
empty table gives no rows; all columns stay in ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.llm.stages import stage

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK = 64
#: A document of more than this part of its source's open words meets all smaller ones at once.
GIANT = 1024
SEED = 20240229
_UNIT = 1 << 20
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """source, source_size, target from (source, size) rows; the weights go round the sources in code-point order, null last.

    One row per source from here on: the sources are the corpora of a mixture, each with a weight.
    """
    per = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = stage(per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
                .withColumn("most", F.lit(float(max_repeat)) * F.col("source_size")), "weights")
    total = float(per.agg(F.sum("source_size")).first()[0] or 0)
    rate, full = 0.0, -1
    while True:  # raise the words per weight until no further source is full
        row = per.agg(F.sum(F.when(F.col("weight") * rate >= F.col("most"), F.col("most")).otherwise(0.0)).alias("held"),
                      F.sum(F.when(F.col("weight") * rate >= F.col("most"), 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum((F.col("weight") * rate >= F.col("most")).cast("long")).alias("n")).first()
        if row["n"] == full or not row["open"]:
            break
        full = row["n"]
        rate = (total - row["held"]) / row["open"]
    return per.select("source", "source_size", F.least(F.col("weight") * F.lit(rate), "most").alias("target"))


def _draw(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) / F.lit(float(1 << 53))


def _fold(units: Column) -> Column:
    """Pivotal rounding of an array of (size, id, mass) in order: the open unit at the end and the decided ones.

    ``size`` and ``mass`` are in the same unit; a unit is integral with mass 0 or size.  The open unit a and the
    next one b exchange as much as makes one of them integral, up or down with chances that keep both expectations.
    """
    def decided(unit: Column, mass: Column) -> Column:
        return F.array(F.struct(unit["id"].alias("id"), (mass > 0).cast("int").alias("extra")))

    def opened(unit: Column, mass: Column, done: Column) -> Column:
        return F.struct(unit["size"].alias("size"), unit["id"].alias("id"), mass.alias("mass"), done.alias("done"))

    def step(a: Column, b: Column) -> Column:
        up = F.least(a["size"] - a["mass"], b["mass"])
        down = F.least(a["mass"], b["size"] - b["mass"])
        moved = F.when(_draw(a["id"], b["id"]) * (up + down) < down, up).otherwise(-down)
        p, q = a["mass"] + moved, b["mass"] - moved
        a_whole, b_whole = (p == 0) | (p == a["size"]), (q == 0) | (q == b["size"])
        none = F.struct(F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("mass"),
                        F.concat(a["done"], decided(a, p), decided(b, q)).alias("done"))
        return (F.when(a["id"].isNull(), opened(b, b["mass"], a["done"]))
                .when(a_whole & b_whole, none)
                .when(a_whole, opened(b, q, F.concat(a["done"], decided(a, p))))
                .otherwise(opened(a, p, F.concat(a["done"], decided(b, q)))))

    start = F.struct(F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("mass"),
                     F.array().cast("array<struct<id:bigint,extra:int>>").alias("done"))
    return F.aggregate(units, start, step)


def _level(units: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One level of the tree, staged: per block the decided units and the open one (size, id, mass)."""
    blocks = units.groupBy(*keys).agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "id", "mass")))).alias("u"))
    return stage(blocks.select(*keys, _fold(F.col("u")).alias("f")).select(*keys, "f.size", "f.id", "f.mass", "f.done"), name)


def _against_rest(units: Column, total: Column, mass: Column) -> Column:
    """Decide an array of (size, id) in order, each against all that follow and the rest of its source.

    ``total`` and ``mass`` are the sums of the source's open sizes and masses; every open unit's mass is size * mass / total.
    A unit goes up by what it lacks or all that the rest has, down by what it has or all that the rest can take, with chances that
    keep its expectation; the rest stays proportional, which keeps theirs.  Result: what is left of both sums, and the decided units.
    """
    def step(acc: Column, u: Column) -> Column:
        room = acc["total"] - u["size"]  # the rest's size
        share = F.round(u["size"] * (acc["mass"] / acc["total"])).cast("long")
        own = F.least(F.greatest(share, acc["mass"] - room, F.lit(0).cast("long")), u["size"], acc["mass"])
        up = F.least(u["size"] - own, acc["mass"] - own)
        down = F.least(own, room - (acc["mass"] - own))
        new = F.when(_draw(u["id"], F.lit(-2)) * (up + down) < down, own + up).otherwise(own - down)
        # a unit that is still open has left nothing open in the rest, so it is rounded alone
        extra = (_draw(u["id"], F.lit(-1)) * u["size"] < new).cast("int")
        return F.struct(room.alias("total"), (acc["mass"] - new).alias("mass"),
                        F.concat(acc["done"], F.array(F.struct(u["id"].alias("id"), extra.alias("extra")))).alias("done"))

    start = F.struct(total.alias("total"), mass.alias("mass"), F.array().cast("array<struct<id:bigint,extra:int>>").alias("done"))
    return F.aggregate(units, start, step)


def copies(units: DataFrame, block: int = BLOCK, giant: int = GIANT) -> DataFrame:
    """(id, extra) of units (source, size, id, mass) with 0 < mass < size: extra is 1 if the mass was rounded up to size.

    ``id`` is a long of its own for every unit; mass / size is the same for all units of a source.
    """
    sums = units.groupBy(F.col("source").alias("_s")).agg(F.sum("size").alias("total"), F.sum("mass").alias("open"))
    level = units.join(sums, F.col("source").eqNullSafe(F.col("_s")))
    large = F.col("size") > F.col("total") / giant
    # fewer than ``giant`` units a source are larger than its total / giant
    first = stage(level.where(large).groupBy("source").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("size", "id")))).alias("u"), F.first("total").alias("total"), F.first("open").alias("open"))
        .select("source", _against_rest(F.col("u"), F.col("total"), F.col("open")).alias("f")), "giants")
    rest = first.select(F.col("source").alias("_r"), F.col("f.total").alias("left"), F.col("f.mass").alias("left_mass"))
    level = level.where(~large).join(rest, F.col("source").eqNullSafe(F.col("_r")), "left")
    share = F.round(F.col("size") * (F.col("left_mass") / F.col("left"))).cast("long")
    level = level.select("source", "size", "id", F.when(F.col("left").isNull(), F.col("mass")).otherwise(F.least(share, "size")).alias("mass"),
                         F.floor(8 * F.log2("size")).cast("int").alias("class"))
    decided_by_giants = first.select(F.explode("f.done").alias("d")).select("d.id", "d.extra")
    decided, most, depth = decided_by_giants, None, 0
    # within the size classes, then across them: one class is left in the second part
    for across in (False, True):
        if across:
            level = level.withColumn("class", F.lit(0))
        while True:
            counts = level.groupBy("source", "class").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
            salted = (level.alias("l").join(counts.alias("c"), F.col("l.source").eqNullSafe(F.col("c.source")) & (F.col("l.class") == F.col("c.class")))
                      .select("l.*", F.pmod(F.xxhash64(F.lit(SEED + depth), "id"), "blocks").alias("slot")))
            done = _level(salted, ["source", "class", "slot"], "rounding")
            out = done.select(F.explode("done").alias("d")).select("d.id", "d.extra")
            decided = decided.unionByName(out)
            level = done.where("id is not null").select("source", "size", "id", "mass", "class")
            most = done.groupBy("source", "class").count().agg(F.max("count")).first()[0]
            depth += 1
            if not most or most <= 1:
                break
    last = level.select("id", (_draw(F.col("id"), F.lit(-1)) * F.col("size") < F.col("mass")).cast("int").alias("extra"))
    return decided.unionByName(last)


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """doc_id, source, size, rows (that are alike), source_size, target, copies: one row per different (doc_id, source, size)."""
    sized = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    units = stage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
                  .withColumn("id", F.xxhash64("doc_id", "source", "size", F.col("doc_id").isNull(), F.col("source").isNull())), "sizes")
    goal = targets(units.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, max_repeat)
    due = (units.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
           .withColumn("_due", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
           .withColumn("whole", F.floor("_due").cast("long"))
           .withColumn("words", F.col("size") * F.col("rows") * _UNIT)
           .withColumn("mass", F.round((F.col("_due") - F.col("whole")) * F.col("words")).cast("long")))
    whole = F.col("whole") + F.when((F.col("mass") >= F.col("words")) & (F.col("words") > 0), 1).otherwise(0)
    due = due.withColumn("whole", whole)
    extra = copies(due.where("mass > 0 and mass < words").select("source", F.col("words").alias("size"), "id", "mass"))
    extra = extra.groupBy("id").agg(F.max("extra").alias("extra"))
    return due.join(extra, "id", "left").select("doc_id", "source", "size", "rows", "source_size", "target",
                                                (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 times: gone), all columns as they are."""
    names = docs.columns
    plan = mix_plan(docs, key, text, source, **options).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"), "copies")
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)])
    k, s, t = (F.col(f"_{names.index(c)}") for c in (key, source, text))
    taken = plain.join(plan.where("copies > 0"), k.eqNullSafe(F.col("_d")) & s.eqNullSafe(F.col("_s")) & (word_count(t) == F.col("_n")))
    return (taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)]))
