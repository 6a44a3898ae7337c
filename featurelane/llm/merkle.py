"""Merkle manifest of a dataset by sibling-shift self-joins.

``leaves`` digests every row; the leaves of a group (lang, say) ascend by key.  ``build`` numbers them and
goes up level by level: a level is one table of (g, n, idx, h); every node equijoins the same
table at its siblings' computed indices (``idx XOR 1`` in a binary tree, slot offsets within the run
of a wider one), and the rows in slot zero, which now hold their whole run, emit the parents.  A
group whose one node remains has its subroot; the subroots, by group, make the tree above in the same way.

``proofs`` goes down again: a node's path is its own siblings and then its parent's path, so a level is one
equijoin of the children with their parents.  ``fold`` recomputes a root from a leaf and a path.

Scale: a level holds a ``1 / arity`` part of the one below, and rows are dealt by (group, index), so that a group with
a third of all rows is spread like any other.  The numbering cuts the sorted leaves into ranges of (group, key,
digest, row) and adds the totals of earlier ranges; one window runs over one row per range and group.
Digests move as 32 bytes; texts are read once and never move.  Every level is a table in the shared folder: a lost executor
costs a re-read.  Only the root and the size of the largest group come to the driver.

Results by case: a null field is ``-``, an empty text ``0:``; null keys come first, rows of one key ascend
by leaf, and equal rows are leaves each (their rows differ in the proof alone); a null group is a group and the first; a lone leaf is its
group's subroot, a lone subroot the root; no rows give no rows; columns other than the fields are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelane.llm.stages import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<slot:int,sibs:array<binary>>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated strings, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(x: Column) -> Column:
    return F.lower(F.hex(x))


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id",
           altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """_group, _key, leaf, and ``other``: the leaf with some fields altered (null where ``where`` isn't true)."""
    names = {f: F.col(f"`{f}`") for f in fields}
    other = digest(*[encoded((altered or {}).get(f, c)) for f, c in names.items()])
    return rows.select(F.col(f"`{group}`").alias("_group"), F.col(f"`{key}`").alias("_key"),
                       digest(*[encoded(c) for c in names.values()]).alias("leaf"),
                       F.when(F.lit(False) if where is None else where, other).alias("other"))


def _numbered(nodes: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``nodes`` with g (ascending with the groups, one number each), n (the group's rows) and idx (from 0).

    ``order`` must be total: its last column is a row number.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*groups, *order]]
    cut = nodes.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    cut = stage(cut.withColumn("_range", F.shiftright("_at", 33)), name)
    blocks = cut.groupBy("_range", *groups).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_g_{c}") for c in groups], "_first",
                           F.min("_first").over(whole).alias("g"), F.sum("_rows").over(whole).alias("n"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_r")
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    out = cut.join(blocks, same).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before"))
    return out.drop("_at", "_range", "_r", "_first", "_before", *[f"_g_{c}" for c in groups])


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Every node with ``sibs``, the digests of its run's other nodes in slot order."""
    joins, found = [], []
    for shift in range(1, arity):
        slot = f"(a.idx + {shift}) % {arity}"
        at = "a.idx ^ 1" if arity == 2 else f"a.idx - a.idx % {arity} + {slot}"
        joins.append(f"LEFT JOIN {{nodes}} b{shift} ON b{shift}.g = a.g AND b{shift}.idx = {at}")
        found.append(f"struct({slot} AS slot, b{shift}.h AS h)")
    return nodes.sparkSession.sql(
        f"SELECT a.*, transform(array_sort(filter(array({', '.join(found)}), x -> x.h IS NOT NULL)), x -> x.h) AS sibs "
        f"FROM {{nodes}} a {' '.join(joins)}", nodes=nodes)


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """What the rows in slot zero emit: one node for each run."""
    run = "concat(lower(hex(h)), array_join(transform(sibs, x -> lower(hex(x))), ''))"
    return level.where(f"n > 1 AND idx % {arity} = 0").selectExpr(
        "g", f"(n + {arity - 1}) div {arity} AS n", f"idx div {arity} AS idx", f"unhex(sha2({run}, 256)) AS h")


def _levels(nodes: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """The tree's levels from the leaves up, each staged with its siblings; groups leave it one level after their subroot."""
    out = [stage(_with_siblings(nodes, arity), f"{name}0")]
    left = out[0].agg(F.max("n")).first()[0] or 0
    while left > 1:
        out.append(stage(_with_siblings(_parents(out[-1], arity), arity), f"{name}{len(out)}"))
        left = -(-left // arity)
    return out


def _down(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """Rows of ``levels[0]`` with the path from there to the root.

    ``above`` has (_g, path, subroot) for each group.  A child's path is its siblings and then its parent's path.
    """
    spark, path = above.sparkSession, None
    entry = f"struct(cast(a.idx % {arity} AS int) AS slot, a.sibs AS sibs)"
    for depth, level in reversed(list(enumerate(levels))):
        keep = level if depth == 0 else level.select("g", "n", "idx", "sibs")
        query = "SELECT a.*, b.path, b.subroot FROM {level} a JOIN {above} b ON a.g = b._g WHERE a.n = 1"
        given = {"level": keep, "above": above}
        if path is not None:
            query += (f" UNION ALL SELECT a.*, concat(array({entry}), b.path) AS path, b.subroot FROM {{level}} a "
                      f"JOIN {{path}} b ON a.g = b.g AND a.idx div {arity} = b.idx WHERE a.n > 1")
            given["path"] = path
        path = spark.sql(query, **given)
        if depth and depth % 2 == 0:
            path = stage(path, "paths")
    return path


def build(found: DataFrame, arity: int = 2) -> tuple[list[DataFrame], list[DataFrame]]:
    """The levels of the groups' trees over ``leaves()`` rows, and those of the tree over their subroots."""
    if arity < 2:
        raise ValueError("arity must be 2 or more")
    found = stage(found.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    nodes = _numbered(found, ["_group"], ["_key", "leaf", "_row"], "ordered")
    low = _levels(nodes.drop("_group", "_row").withColumnRenamed("leaf", "h"), arity, "level")
    roots = low[0].where("n = 1").select("g", "h")
    for level in low[1:]:
        roots = roots.unionByName(level.where("n = 1").select("g", "h"))
    top = _numbered(roots.withColumnRenamed("g", "_of"), [], ["_of"], "subroots")
    return low, _levels(top, arity, "top")


def proofs(low: list[DataFrame], top: list[DataFrame], arity: int = 2) -> DataFrame:
    """_key, leaf, other, subroot, root (bytes) and path of every leaf; path has slot and siblings by level."""
    summit = top[-1].where("n = 1").select("h").first()
    root = F.lit(summit[0] if summit else None).cast("binary")
    end = top[-1].where("n = 1").select(F.col("g").alias("_g"), F.array().cast(_PATH).alias("path"), F.col("h").alias("subroot"))
    over = _down(top, end, arity).select(F.col("_of").alias("_g"), "path", F.col("h").alias("subroot"))
    return _down(low, stage(over, "over"), arity).select("_key", F.col("h").alias("leaf"), "other", "subroot", root.alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf (bytes) and its path give."""
    def step(node: Column, x: Column) -> Column:
        sibs = F.transform(x["sibs"], hexed)
        left = F.array_join(F.slice(sibs, F.lit(1), x["slot"]), "")
        right = F.array_join(F.slice(sibs, x["slot"] + 1, F.size(sibs) - x["slot"]), "")
        return F.sha2(F.concat(left, node, right).cast("binary"), 256)
    return F.aggregate(path, hexed(leaf), step)


def proof_digest(path: Column) -> Column:
    """SHA-256 (hex) of the path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(F.flatten(F.transform(path, lambda x: x["sibs"])), hexed), "").cast("binary"), 256)


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", arity: int = 2,
             altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Key, leaf, subroot, root, proof_sha256, folded_root (hex), verified and path of every row.

    ``altered`` and ``where`` say which rows are read with other values when their leaf is folded again.
    """
    low, top = build(leaves(rows, fields, group, key, altered, where), arity)
    found = proofs(low, top, arity)
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    out = found.select(F.col("_key").alias(key), hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                       hexed(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                       folded.alias("folded_root"), "path")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda x, i: xor(x // 2, 3988292384 * (x % 2))))"""


def _sql_leaf(n_chars: str) -> str:
    parts = [f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"
             for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


#: The manifest of ``documents`` by lang, with 1 added to n_chars where 7 divides the CRC-32 of doc_id.
ORACLE = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
         CASE WHEN xor(4294967295, {_CRC}) % 7 = 0 THEN {_sql_leaf("n_chars + 1")} ELSE {_sql_leaf("n_chars")} END AS other
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM base),
low(g, lvl, n, idx, h) AS (
  SELECT g, 0, n, idx, leaf FROM leaves
  UNION ALL SELECT g, lvl + 1, (n + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY g, lvl, n, idx // 2),
subroots AS (SELECT g, lvl AS height, h AS subroot, count(*) OVER () AS n FROM low WHERE n = 1),
top(lvl, n, idx, h) AS (
  SELECT 0, n, g, subroot FROM subroots
  UNION ALL SELECT lvl + 1, (n + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, n, idx // 2),
summit AS (SELECT lvl AS height, h AS root FROM top WHERE n = 1),
steps AS (
  SELECT l.g, l.idx AS leaf_idx, s.lvl, CASE WHEN t.h IS NULL THEN '-' WHEN t.idx % 2 = 0 THEN 'L' || t.h ELSE 'R' || t.h END AS step
  FROM leaves l JOIN subroots r USING (g) CROSS JOIN (SELECT unnest(range(64)) AS lvl) s
  LEFT JOIN low t ON t.g = l.g AND t.lvl = s.lvl AND t.idx = xor(l.idx >> s.lvl, 1) WHERE s.lvl < r.height
  UNION ALL
  SELECT l.g, l.idx, 64 + s.lvl, CASE WHEN t.h IS NULL THEN '-' WHEN t.idx % 2 = 0 THEN 'L' || t.h ELSE 'R' || t.h END
  FROM leaves l CROSS JOIN summit r CROSS JOIN (SELECT unnest(range(64)) AS lvl) s
  LEFT JOIN top t ON t.lvl = s.lvl AND t.idx = xor(l.g >> s.lvl, 1) WHERE s.lvl < r.height),
paths AS (SELECT g, leaf_idx, list(step ORDER BY lvl) AS path FROM steps GROUP BY g, leaf_idx),
out AS (
  SELECT l.doc_id, l.leaf, r.subroot, s.root, sha256(coalesce(array_to_string(list_transform(p.path, lambda x: CASE WHEN x = '-' THEN '' ELSE x[2:] END), ''), '')) AS proof_sha256,
         list_reduce(list_prepend(l.other, coalesce(p.path, [])), lambda node, x: sha256(
           CASE WHEN x = '-' THEN node WHEN x[1] = 'L' THEN x[2:] || node ELSE node || x[2:] END)) AS folded_root
  FROM leaves l JOIN subroots r USING (g) CROSS JOIN summit s LEFT JOIN paths p ON p.g = l.g AND p.leaf_idx = l.idx)
SELECT *, folded_root = root AS verified FROM out
"""
