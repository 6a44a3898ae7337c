"""DuckDB SQL equivalents of the registered queries (same column names)."""

ORACLE: dict[str, str] = {}

ORACLE["history_user_item"] = """
WITH log AS (
  SELECT user_id, json_extract_string(props, '$.k') AS item,
         CAST(event_type = 'purchase' AS INTEGER) AS target
  FROM events),
agg AS (
  SELECT user_id, item, CAST(count(target) AS DOUBLE) AS cnt, avg(target) AS mean
  FROM log WHERE item IS NOT NULL GROUP BY user_id, item),
hist AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item) AS pos FROM agg)
SELECT c.c_custkey AS user_id, c.c_mktsegment,
       COALESCE(h.pos, 1) AS pos, COALESCE(h.item, '') AS item,
       COALESCE(h.cnt, 0.0) AS cnt, ROUND(COALESCE(h.mean, 0.0), 6) AS mean_target
FROM customer c LEFT JOIN hist h ON c.c_custkey = h.user_id
"""

_LINEITEM_LOG = """
log AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_linestatus, l.l_shipdate,
         CAST(l.l_returnflag = 'R' AS INTEGER) AS target,
         o.o_custkey, o.o_orderstatus, o.o_orderpriority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

ORACLE["history_user_token"] = f"""
WITH {_LINEITEM_LOG},
toks AS (
  SELECT log.o_custkey, log.target,
         unnest(COALESCE(string_split(p.p_name, ' '), ['']))  AS token
  FROM log LEFT JOIN part p ON log.l_partkey = p.p_partkey),
agg AS (
  SELECT o_custkey, token, CAST(count(target) AS DOUBLE) AS cnt, avg(target) AS mean
  FROM toks WHERE token IS NOT NULL GROUP BY o_custkey, token),
hist AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY token) AS pos FROM agg)
SELECT c.c_custkey AS o_custkey, COALESCE(h.pos, 1) AS pos, COALESCE(h.token, '') AS token,
       COALESCE(h.cnt, 0.0) AS cnt, ROUND(COALESCE(h.mean, 0.0), 6) AS mean_target
FROM customer c LEFT JOIN hist h ON c.c_custkey = h.o_custkey
"""

ORACLE["pos_neg_items"] = """
WITH log AS (
  SELECT user_id, event_id, ts, json_extract_string(props, '$.k') AS item,
         CASE WHEN event_type = 'purchase' THEN 'pos' ELSE 'neg' END AS polarity
  FROM events),
lists AS (
  SELECT user_id, polarity, item,
         row_number() OVER (PARTITION BY user_id, polarity ORDER BY ts, event_id) AS pos
  FROM log),
grid AS (
  SELECT u.user_id, p.polarity FROM (SELECT DISTINCT user_id FROM events) u,
         (VALUES ('pos'), ('neg')) p(polarity))
SELECT g.user_id, g.polarity, COALESCE(l.pos, 1) AS pos, COALESCE(l.item, '') AS item,
       CAST(CASE WHEN l.user_id IS NULL THEN 0.0 ELSE 1.0 END AS DOUBLE) AS weight
FROM grid g LEFT JOIN lists l ON g.user_id = l.user_id AND g.polarity = l.polarity
"""

ORACLE["item_popularity"] = f"""
WITH {_LINEITEM_LOG},
pop AS (SELECT l_partkey, CAST(count(target) AS DOUBLE) AS item_clicks, avg(target) AS item_pplrty
        FROM log GROUP BY l_partkey),
parts AS (SELECT p.p_partkey, pop.item_clicks, pop.item_pplrty
          FROM part p LEFT JOIN pop ON p.p_partkey = pop.l_partkey),
med AS (SELECT quantile_cont(item_clicks, 0.5) AS mc, quantile_cont(item_pplrty, 0.5) AS mp FROM parts)
SELECT p_partkey, COALESCE(item_clicks, mc) AS item_clicks, ROUND(COALESCE(item_pplrty, mp), 6) AS item_pplrty
FROM parts, med
"""

ORACLE["history_multi_unpivot"] = f"""
WITH {_LINEITEM_LOG},
stacked AS (
  SELECT o_custkey, target, 'l_linestatus' AS feature, l_linestatus AS value FROM log
  UNION ALL SELECT o_custkey, target, 'o_orderstatus', o_orderstatus FROM log
  UNION ALL SELECT o_custkey, target, 'o_orderpriority', o_orderpriority FROM log),
agg AS (SELECT o_custkey, feature, value, CAST(count(target) AS DOUBLE) AS cnt, avg(target) AS mean
        FROM stacked WHERE value IS NOT NULL GROUP BY o_custkey, feature, value)
SELECT o_custkey, feature, row_number() OVER (PARTITION BY o_custkey, feature ORDER BY value) AS pos,
       value, cnt, ROUND(mean, 6) AS mean_target
FROM agg
"""

ORACLE["activity_split"] = """
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
q AS (SELECT CAST(floor(quantile_cont(n, 0.25)) AS BIGINT) AS lo,
             CAST(floor(quantile_cont(n, 0.75)) AS BIGINT) AS hi FROM n),
r AS (SELECT e.event_id, e.user_id, n.n,
             row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rd
      FROM events e JOIN n ON e.user_id = n.user_id),
k AS (SELECT r.*, least(r.n, q.hi) AS len FROM r, q WHERE r.n >= q.lo)
SELECT event_id, user_id,
       CASE WHEN len - rd + 1 <= floor(len * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split
FROM k WHERE rd <= len
"""

ORACLE["chrono_split"] = """
WITH r AS (SELECT o_orderkey, o_custkey,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ra,
                  count(*) OVER (PARTITION BY o_custkey) AS n
           FROM orders)
SELECT o_orderkey, o_custkey,
       CASE WHEN ra <= n - floor(n * CAST(0.3 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split
FROM r
"""

ORACLE["latest_n"] = """
SELECT o_orderkey, o_custkey, rn FROM (
  SELECT o_orderkey, o_custkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn <= 3
"""

ORACLE["group_sizes"] = """
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT ROUND(CAST(count(n) AS DOUBLE), 6) AS count, ROUND(avg(n), 6) AS mean, ROUND(stddev_samp(n), 6) AS std,
       ROUND(CAST(min(n) AS DOUBLE), 6) AS min, ROUND(CAST(max(n) AS DOUBLE), 6) AS max,
       ROUND(quantile_cont(n, 0.25), 6) AS q25, ROUND(quantile_cont(n, 0.5), 6) AS q50,
       ROUND(quantile_cont(n, 0.75), 6) AS q75
FROM n
"""

ORACLE["freq_encode"] = """
WITH c AS (SELECT p.p_brand AS label, count(*) AS freq
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
           WHERE p.p_brand IS NOT NULL AND p.p_brand <> '' GROUP BY p.p_brand),
v AS (SELECT label, row_number() OVER (ORDER BY freq DESC, label) AS idx FROM c)
SELECT p.p_partkey, p.p_brand, CAST(COALESCE(v.idx, 0) AS INTEGER) AS brand_id
FROM part p LEFT JOIN v ON p.p_brand = v.label
"""

ORACLE["sorted_encode"] = """
WITH v AS (SELECT label, row_number() OVER (ORDER BY label) AS idx
           FROM (SELECT DISTINCT p_type AS label FROM part WHERE p_type IS NOT NULL AND p_type <> ''))
SELECT p.p_partkey, p.p_type, CAST(COALESCE(v.idx, 0) AS INTEGER) AS type_id
FROM part p LEFT JOIN v ON p.p_type = v.label
"""

ORACLE["array_encode"] = """
WITH toks AS (SELECT p_partkey, unnest(COALESCE(string_split(p_name, ' '), [''])) AS token,
                     generate_subscripts(COALESCE(string_split(p_name, ' '), ['']), 1) AS pos
              FROM part),
c AS (SELECT token AS label, count(*) AS freq FROM toks WHERE token IS NOT NULL AND token <> '' GROUP BY token),
v AS (SELECT label, row_number() OVER (ORDER BY freq DESC, label) AS idx FROM c)
SELECT t.p_partkey, CAST(t.pos AS BIGINT) AS pos, t.token, CAST(COALESCE(v.idx, 0) AS INTEGER) AS token_id
FROM toks t LEFT JOIN v ON t.token = v.label
"""

ORACLE["decode"] = """
WITH v AS (SELECT label, row_number() OVER (ORDER BY label) AS idx
           FROM (SELECT DISTINCT o_orderpriority AS label FROM orders
                 WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> '')),
e AS (SELECT o.o_orderkey, CAST(COALESCE(v.idx, 0) AS INTEGER) AS prio_id
      FROM orders o LEFT JOIN v ON o.o_orderpriority = v.label)
SELECT e.o_orderkey, e.prio_id, d.label AS decoded, n.label AS next_label
FROM e LEFT JOIN v d ON e.prio_id = d.idx LEFT JOIN v n ON e.prio_id + 1 = n.idx
"""

ORACLE["standardize_pop"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS x FROM customer),
s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd, quantile_cont(x, 0.5) AS med FROM c)
SELECT c_custkey, ROUND((COALESCE(x, med) - m) / CASE WHEN sd IS NULL OR sd = 0 THEN 1 ELSE sd END, 6) AS acctbal_z
FROM c, s
"""

ORACLE["standardize_samp"] = """
WITH s AS (SELECT avg(p_retailprice) AS m1, stddev_samp(p_retailprice) AS s1,
                  avg(p_size) AS m2, stddev_samp(p_size) AS s2 FROM part)
SELECT p_partkey, ROUND((p_retailprice - m1) / s1, 6) AS price_z, ROUND((p_size - m2) / s2, 6) AS size_z
FROM part, s
"""

# HTML unescape as one left-to-right pass (same rules as the Spark side):
# split around character references, decode each, glue back.
_ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _decode_case() -> str:
    """One reference ``e`` by the tables of Python's standard library (the library under test is not imported)."""
    from html import _invalid_charrefs, _invalid_codepoints
    from html.entities import html5
    q = lambda t: "'" + t.replace("'", "''") + "'"
    table = "MAP([" + ", ".join(q(n) for n in html5) + "], [" + ", ".join(q(t) for t in html5.values()) + "])"
    bare = "[" + ", ".join(q(n) for n in sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + "]"
    special = {n: t for n, t in _invalid_charrefs.items() if n}  # chr(0) is no DuckDB text; 0 gives U+FFFD below
    remap = "MAP([" + ", ".join(map(str, special)) + "], [" + ", ".join(f"chr({ord(t)})" for t in special.values()) + "])"
    none = ", ".join(map(str, sorted(_invalid_codepoints)))
    dec = "TRY_CAST(regexp_extract(e, '^&#([0-9]+);?$', 1) AS BIGINT)"
    hexv = "TRY_CAST('0x' || regexp_extract(e, '^&#[xX]([0-9a-fA-F]+);?$', 1) AS BIGINT)"
    whens = []
    for v, pat in ((dec, "^&#[0-9]+;?$"), (hexv, "^&#[xX][0-9a-fA-F]+;?$")):
        whens.append(f"WHEN regexp_matches(e, '{pat}') THEN CASE WHEN map_contains({remap}, {v}::INTEGER) THEN {remap}[{v}::INTEGER] "
                     f"WHEN {v} IS NULL OR {v} = 0 OR {v} > 1114111 OR {v} BETWEEN 55296 AND 57343 THEN '\ufffd' "
                     f"WHEN {v} IN ({none}) THEN '' ELSE chr(CAST({v} AS INTEGER)) END".replace(f"map_contains({remap}, {v}::INTEGER)", f"{v} < 256 AND map_contains({remap}, {v}::INTEGER)"))
    prefix = f"list_filter({bare}, lambda n: length(n) < length(e) - 1 AND starts_with(e[2:], n))"
    whens.append(f"WHEN map_contains({table}, e[2:]) THEN {table}[e[2:]]")
    whens.append(f"WHEN len({prefix}) > 0 THEN {table}[{prefix}[1]] || substr(e, 2 + length({prefix}[1]))")
    return "CASE " + " ".join(whens) + " ELSE e END"


def _unescape(expr: str) -> str:
    parts = f"regexp_split_to_array({expr}, '{_ENTITY}')"
    ents = f"list_transform(regexp_extract_all({expr}, '{_ENTITY}'), lambda e: {_decode_case()})"
    glued = f"list_transform(list_zip({parts}, list_concat({ents}, [''])), lambda z: z[1] || COALESCE(z[2], ''))"
    return f"CASE WHEN {expr} IS NULL THEN NULL WHEN NOT contains({expr}, '&') THEN {expr} ELSE array_to_string({glued}, '') END"


def _clean(expr: str) -> str:
    x = _unescape(f"COALESCE({expr}, '')")
    x = rf"regexp_replace({x}, '[^.\p{{L}}\p{{N}}_|]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '^[ |]+|[ |]+$', '', 'g')"
    return rf"list_sort(string_split_regex({x}, ' *\|+ *'))"


ORACLE["multivalue_clean"] = f"""
WITH d AS (SELECT doc_id, {_clean('text')} AS vals FROM documents)
SELECT doc_id, CAST(len(vals) AS INTEGER) AS n_vals,
       CAST(generate_subscripts(vals, 1) AS BIGINT) AS pos, unnest(vals) AS val
FROM d
"""

ORACLE["entity_unescape"] = f"""
WITH u AS (SELECT page_id, {_unescape('html')} AS u FROM pages)
SELECT page_id, CAST(length(u) AS INTEGER) AS n_chars, md5(u) AS md5 FROM u
"""

ORACLE["longest_elements"] = f"""
WITH e AS (SELECT unnest({_clean('text')}) AS val FROM documents)
SELECT CAST(length(val) AS INTEGER) AS n_chars, md5(val) AS md5 FROM e
ORDER BY n_chars DESC, md5 LIMIT 10
"""

ORACLE["code_decode"] = """
WITH c AS (SELECT c_custkey, c_acctbal, substr(c_name, 10, 9) AS code FROM customer),
d AS (SELECT c_custkey,
             COALESCE(CAST(CAST(trunc(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE)) AS BIGINT) AS VARCHAR), '') AS acct_code,
             COALESCE(substr(code, 1, 2), '') AS cc, COALESCE(substr(code, 3, 3), '') AS xxx,
             CAST(CASE WHEN TRY_CAST(substr(code, 6, 2) AS INTEGER) < 18 THEN 2000 + TRY_CAST(substr(code, 6, 2) AS INTEGER)
                       WHEN TRY_CAST(substr(code, 6, 2) AS INTEGER) IS NOT NULL THEN 1900 + TRY_CAST(substr(code, 6, 2) AS INTEGER)
                  END AS DOUBLE) AS yy
      FROM c),
m AS (SELECT quantile_cont(yy, 0.5) AS med FROM d)
SELECT c_custkey, acct_code, cc, xxx, COALESCE(yy, med) - 1900 AS yy FROM d, m
"""

ORACLE["bucket_labels"] = """
SELECT p_partkey,
       CASE WHEN p_size IS NULL OR p_size < 6 THEN '' WHEN p_size < 10 THEN '6-10' WHEN p_size < 20 THEN '10-20'
            WHEN p_size < 30 THEN '20-30' WHEN p_size < 40 THEN '30-40' WHEN p_size < 60 THEN '40-60'
            WHEN p_size < 80 THEN '60-80' ELSE '' END AS size_catg, 'part' AS src
FROM part
UNION ALL
SELECT c_custkey, CASE WHEN c_acctbal IS NULL OR c_acctbal < 0 THEN 'neg' WHEN c_acctbal < 1000 THEN '0-1k'
                       WHEN c_acctbal < 5000 THEN '1k-5k' ELSE '5k+' END, 'customer'
FROM customer
"""

ORACLE["date_features"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', d) AS DOUBLE) AS days,
       CAST(year(d) AS VARCHAR) AS year, CAST(month(d) AS VARCHAR) AS month, CAST(day(d) AS VARCHAR) AS day,
       CAST(date_diff('day', DATE '1970-01-01', make_date(year(d), month(d), 1)) AS BIGINT) AS month_start,
       CAST(date_diff('day', DATE '1970-01-01', make_date(year(d), 1, 1)) AS BIGINT) AS year_start,
       round_even((date_diff('day', DATE '1970-01-01', d) - 8035.0) / 365.0, 0) AS tenure_years
FROM o
"""

ORACLE["range_median"] = """
WITH m AS (SELECT quantile_cont(p_size, 0.5) AS med FROM part WHERE p_size BETWEEN 6 AND 40)
SELECT p_partkey, CASE WHEN p_size BETWEEN 6 AND 40 THEN CAST(p_size AS DOUBLE) ELSE med END AS size
FROM part, m
"""

ORACLE["fill_median"] = """
WITH p AS (SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_retailprice END AS price,
                  CASE WHEN p_size <= 45 THEN CAST(p_size AS DOUBLE) END AS size FROM part),
m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(size, 0.5) AS ms FROM p)
SELECT p_partkey, COALESCE(price, mp) AS price, COALESCE(size, ms) AS size FROM p, m
"""

_GAPS = """
g AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal,
             CASE WHEN c_nationkey <> 0 THEN c_nationkey END AS nat FROM customer)
"""

ORACLE["fill_defaults"] = f"""
WITH {_GAPS}, m AS (SELECT quantile_cont(bal, 0.5) AS mb FROM g)
SELECT c_custkey, COALESCE(seg, '') AS seg, ROUND(COALESCE(bal, mb), 6) AS bal, COALESCE(nat, 0) AS nat FROM g, m
"""

ORACLE["missing_fraction"] = f"""
WITH {_GAPS}
SELECT ROUND(avg(CASE WHEN seg IS NULL OR seg = '' THEN 1 ELSE 0 END), 6) AS seg,
       ROUND(avg(CASE WHEN bal IS NULL OR CAST(bal AS VARCHAR) = '' THEN 1 ELSE 0 END), 6) AS bal,
       ROUND(avg(CASE WHEN nat IS NULL OR CAST(nat AS VARCHAR) = '' THEN 1 ELSE 0 END), 6) AS nat
FROM g
"""

ORACLE["unnest_stats"] = """
WITH p AS (SELECT p_partkey, COALESCE(string_split(p_name, ' '), ['']) AS tokens FROM part)
SELECT token, count(*) AS cnt, ROUND(avg(n_tokens), 6) AS mean_len
FROM (SELECT unnest(tokens) AS token, len(tokens) AS n_tokens FROM p) GROUP BY token
"""

ORACLE["interval_flag"] = """
WITH o AS (SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) AS m,
                  CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END AS promo,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'Jan,Apr,Jul,Oct' WHEN '2-HIGH' THEN 'Feb,May,Aug,Nov'
                                       WHEN '3-MEDIUM' THEN 'Mar,Jun,Sept,Dec' END AS iv FROM orders)
SELECT o_orderkey,
       CASE WHEN promo = '1' AND COALESCE(list_contains(list_transform(string_split(iv, ','), lambda x:
            CASE x WHEN 'Jan' THEN '1' WHEN 'Feb' THEN '2' WHEN 'Mar' THEN '3' WHEN 'Apr' THEN '4'
                   WHEN 'May' THEN '5' WHEN 'Jun' THEN '6' WHEN 'Jul' THEN '7' WHEN 'Aug' THEN '8'
                   WHEN 'Sept' THEN '9' WHEN 'Oct' THEN '10' WHEN 'Nov' THEN '11' WHEN 'Dec' THEN '12' END), m), false)
            THEN '1' ELSE '0' END AS promo_flag
FROM o
"""

ORACLE["fat_table"] = f"""
WITH {_LINEITEM_LOG},
c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal FROM customer),
cv AS (SELECT label, row_number() OVER (ORDER BY label) AS idx
       FROM (SELECT DISTINCT c_mktsegment AS label FROM c WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> '')),
cs AS (SELECT avg(acctbal) AS m, stddev_pop(acctbal) AS sd, quantile_cont(acctbal, 0.5) AS med FROM c),
cu AS (SELECT c.c_custkey, COALESCE(cv.idx, 0) AS seg_id, (COALESCE(c.acctbal, cs.med) - cs.m) / cs.sd AS acctbal_z
       FROM c LEFT JOIN cv ON c.c_mktsegment = cv.label, cs),
pv AS (SELECT label, row_number() OVER (ORDER BY label) AS idx
       FROM (SELECT DISTINCT p_brand AS label FROM part WHERE p_brand IS NOT NULL AND p_brand <> '')),
ps AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS sd, quantile_cont(p_retailprice, 0.5) AS med FROM part),
pa AS (SELECT p.p_partkey, COALESCE(pv.idx, 0) AS brand_id, (COALESCE(p.p_retailprice, ps.med) - ps.m) / ps.sd AS price_z
       FROM part p LEFT JOIN pv ON p.p_brand = pv.label, ps)
SELECT log.o_custkey AS raw_o_custkey, log.l_partkey AS raw_l_partkey, log.l_orderkey, log.l_linenumber,
       CAST(COALESCE(cu.seg_id, 0) AS INTEGER) AS seg_id,
       ROUND(COALESCE(cu.acctbal_z, (SELECT (med - m) / sd FROM cs)), 6) AS acctbal_z,
       CAST(COALESCE(pa.brand_id, 0) AS INTEGER) AS brand_id,
       ROUND(COALESCE(pa.price_z, (SELECT (med - m) / sd FROM ps)), 6) AS price_z, log.target
FROM log LEFT JOIN cu ON log.o_custkey = cu.c_custkey LEFT JOIN pa ON log.l_partkey = pa.p_partkey
"""

_PART_COUNTS = "pc AS (SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey)"

ORACLE["semi_topk"] = f"""
WITH {_PART_COUNTS}, top AS (SELECT l_partkey FROM pc ORDER BY cnt DESC, l_partkey LIMIT 20)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM top)
"""

ORACLE["semi_join_keys"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size >= 40)
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
"""

ORACLE["having_counts"] = """
SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey HAVING count(*) >= 35
"""

ORACLE["topk_offset"] = f"""
WITH {_PART_COUNTS}
SELECT l_partkey, cnt, rank FROM (
  SELECT l_partkey, cnt, row_number() OVER (ORDER BY cnt DESC, l_partkey) AS rank FROM pc)
WHERE rank BETWEEN 2 AND 30
"""

ORACLE["group_mean_rows"] = """
SELECT o_orderkey, o_custkey, ROUND(avg(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS cust_mean FROM orders
"""

_OC = """
oc AS (SELECT o.o_orderpriority AS prio, o.o_orderstatus, CAST(o.o_orderstatus = 'F' AS INTEGER) AS target, c.c_mktsegment
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
"""
_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


ORACLE["pivot_mean_count"] = f"""
WITH {_OC}
SELECT c_mktsegment,
       {", ".join(f"ROUND(COALESCE(avg(target) FILTER (WHERE prio = '{p}'), 0), 6) AS mean_{_safe(p)}, "
                  f"count(*) FILTER (WHERE prio = '{p}') AS count_{_safe(p)}" for p in _PRIOS)}
FROM oc GROUP BY c_mktsegment
"""

ORACLE["facet_pivot"] = f"""
WITH {_OC}
SELECT c_mktsegment, o_orderstatus,
       {", ".join(f"count(*) FILTER (WHERE prio = '{p}') AS cnt_{_safe(p)}" for p in _PRIOS)}
FROM oc GROUP BY c_mktsegment, o_orderstatus
"""


def _describe(x: str) -> str:
    return ", ".join([f"ROUND(CAST(count({x}) AS DOUBLE), 6) AS count", f"ROUND(avg({x}), 6) AS mean",
                      f"ROUND(stddev_samp({x}), 6) AS std", f"ROUND(min({x}), 6) AS min", f"ROUND(max({x}), 6) AS max",
                      f"ROUND(CAST(sum(CAST({x} AS DECIMAL(38,10))) AS DOUBLE), 6) AS sum",
                      f"ROUND(quantile_cont({x}, 0.25), 6) AS q25",
                      f"ROUND(quantile_cont({x}, 0.5), 6) AS q50", f"ROUND(quantile_cont({x}, 0.75), 6) AS q75"])


ORACLE["describe_groups"] = f"SELECT l_returnflag, {_describe('l_quantity')} FROM lineitem GROUP BY l_returnflag"

ORACLE["describe_global"] = f"SELECT {_describe('o_totalprice')} FROM orders"

ORACLE["sample_rows"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY md5('42|' || coalesce(CAST(l_orderkey AS VARCHAR), '') || '|' || coalesce(CAST(l_linenumber AS VARCHAR), '')),
         l_orderkey, l_linenumber LIMIT 100
"""

ORACLE["box_stats"] = """
WITH q AS (SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag, l_linestatus),
j AS (SELECT l.l_returnflag, l.l_linestatus, l.l_extendedprice AS x, q.q1, q.median, q.q3,
             q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
      FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag AND l.l_linestatus = q.l_linestatus
      WHERE l.l_extendedprice IS NOT NULL)
SELECT l_returnflag, l_linestatus, ROUND(first(q1), 6) AS q1, ROUND(first(median), 6) AS median,
       ROUND(first(q3), 6) AS q3, ROUND(avg(x), 6) AS mean,
       ROUND(min(x) FILTER (WHERE x >= lo), 6) AS whisker_lo, ROUND(max(x) FILTER (WHERE x <= hi), 6) AS whisker_hi,
       CAST(sum(CASE WHEN x < lo OR x > hi THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM j GROUP BY l_returnflag, l_linestatus
"""

ORACLE["histogram"] = """
WITH r AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
           FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag),
b AS (SELECT l.l_returnflag, r.lo, r.hi,
             CAST(CASE WHEN r.hi = r.lo THEN 0
                       ELSE least(floor((l.l_extendedprice - r.lo) / (r.hi - r.lo) * 10), 9) END AS INTEGER) AS bin
      FROM lineitem l JOIN r ON l.l_returnflag = r.l_returnflag WHERE l.l_extendedprice IS NOT NULL)
SELECT l_returnflag, bin, count(*) AS cnt, ROUND(first(lo), 6) AS lo, ROUND(first(hi), 6) AS hi
FROM b GROUP BY l_returnflag, bin
"""

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE["corr_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:])

ORACLE["trend_line"] = f"""
WITH {_LINEITEM_LOG},
pop AS (SELECT l_partkey, CAST(count(target) AS DOUBLE) AS clicks, avg(target) AS pplrty FROM log GROUP BY l_partkey),
r AS (SELECT pplrty, row_number() OVER (ORDER BY clicks DESC, l_partkey) AS rank FROM pop)
SELECT ROUND(regr_slope(pplrty, rank), 6) AS slope, ROUND(regr_intercept(pplrty, rank), 6) AS intercept,
       ROUND(regr_r2(pplrty, rank), 6) AS r2, CAST(regr_count(pplrty, rank) AS BIGINT) AS n
FROM r WHERE rank BETWEEN 2 AND 100
"""

ORACLE["pad_batches"] = """
WITH c AS (SELECT conv_id, turn, COALESCE(string_split(text, ' '), ['']) AS toks FROM conversations),
cnt AS (SELECT tok AS label, count(*) AS freq FROM (SELECT unnest(toks) AS tok FROM c)
        WHERE tok IS NOT NULL AND tok <> '' GROUP BY tok),
v AS (SELECT label, row_number() OVER (ORDER BY freq DESC, label) AS idx FROM cnt),
b AS (SELECT conv_id, turn, toks, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 64 AS batch_id FROM c),
m AS (SELECT batch_id, max(len(toks)) AS ml FROM b GROUP BY batch_id),
e AS (SELECT conv_id, turn, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM b),
g AS (SELECT b.conv_id, b.turn, b.batch_id, unnest(range(1, m.ml + 1)) AS pos FROM b JOIN m ON b.batch_id = m.batch_id)
SELECT g.conv_id, g.turn, g.batch_id, CAST(g.pos AS BIGINT) AS pos, CAST(COALESCE(v.idx, 0) AS INTEGER) AS token_id
FROM g LEFT JOIN e ON g.conv_id = e.conv_id AND g.turn = e.turn AND g.pos = e.pos LEFT JOIN v ON e.tok = v.label
"""

_EMB = """
e AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
dm AS (SELECT CAST(unnest(range(0, max(dim) + 1)) AS INTEGER) AS dim FROM e),
log AS (SELECT user_id, json_extract_string(props, '$.k') AS item,
               CAST(event_type = 'purchase' AS INTEGER) AS target FROM events),
h AS (SELECT user_id, item, CAST(count(target) AS DOUBLE) AS w FROM log WHERE item IS NOT NULL GROUP BY user_id, item),
n AS (SELECT user_id, sqrt(sum(w * w)) AS norm FROM h GROUP BY user_id),
pw AS (SELECT h.user_id, dm.dim, sum(COALESCE(e.x, 0.0) * (h.w / n.norm)) AS x
       FROM h JOIN n ON h.user_id = n.user_id CROSS JOIN dm
       LEFT JOIN e ON CAST(h.item AS BIGINT) = e.vec_id AND e.dim = dm.dim GROUP BY h.user_id, dm.dim),
ln AS (SELECT user_id, count(*) AS len FROM log WHERE target = 1 GROUP BY user_id),
pp AS (SELECT s.user_id, s.dim, s.x / sqrt(ln.len) AS x FROM
         (SELECT l.user_id, dm.dim, sum(COALESCE(e.x, 0.0)) AS x FROM log l CROSS JOIN dm
          LEFT JOIN e ON CAST(l.item AS BIGINT) = e.vec_id AND e.dim = dm.dim
          WHERE l.target = 1 GROUP BY l.user_id, dm.dim) s JOIN ln ON s.user_id = ln.user_id)
"""

ORACLE["pooling_weighted"] = f"WITH {_EMB} SELECT user_id, dim, ROUND(x, 6) AS x FROM pw"
ORACLE["pooling_mean_sqrt"] = f"WITH {_EMB} SELECT user_id, dim, ROUND(x, 6) AS x FROM pp"
ORACLE["vector_product"] = f"""
WITH {_EMB}
SELECT COALESCE(pw.user_id, pp.user_id) AS user_id, COALESCE(pw.dim, pp.dim) AS dim,
       ROUND(COALESCE(pw.x, 0) * COALESCE(pp.x, 0), 6) AS x
FROM pw FULL JOIN pp ON pw.user_id = pp.user_id AND pw.dim = pp.dim
"""

ORACLE["metrics_regression"] = """
WITH p AS (SELECT l_extendedprice AS y, avg(l_extendedprice) OVER (PARTITION BY l_partkey) AS pred FROM lineitem)
SELECT ROUND(sqrt(avg(CASE WHEN y > 0 THEN ((y - pred) / y) * ((y - pred) / y) END)), 6) AS rmspe,
       ROUND(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse, ROUND(avg(abs(y - pred)), 6) AS mae
FROM p
"""

_SCORED = """
d AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
st AS (SELECT s, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg, count(*) AS c FROM d GROUP BY s)
"""

ORACLE["roc_auc"] = f"""
WITH {_SCORED},
r AS (SELECT *, sum(c) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - c + (c + 1) / 2.0 AS ar FROM st),
a AS (SELECT (sum(pos * ar) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * sum(neg)) AS auc FROM r),
z AS (SELECT y, (s - avg(s) OVER ()) / stddev_pop(s) OVER () AS z FROM d),
l AS (SELECT avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))) AS logloss FROM z)
SELECT ROUND(a.auc, 6) AS auc, ROUND(l.logloss, 6) AS logloss FROM a, l
"""

ORACLE["roc_curve"] = f"""
WITH {_SCORED}, t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM st)
SELECT ROUND(s, 6) AS score,
       ROUND(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / t.P, 6) AS tpr,
       ROUND(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / t.N, 6) AS fpr
FROM st, t
"""

ORACLE["series_compare"] = """
WITH daily AS (SELECT c.c_nationkey AS nation, CAST(date_diff('day', DATE '1970-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS day,
                      CAST(sum(CAST(o.o_totalprice AS DECIMAL(38,10))) AS DOUBLE) AS actual
               FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY day) AS ra, count(*) OVER (PARTITION BY nation) AS n FROM daily),
s AS (SELECT *, ra <= n - floor(n * CAST(0.3 AS DOUBLE)) AS is_train FROM r),
m AS (SELECT nation, avg(actual) AS mean FROM s WHERE is_train GROUP BY nation),
u AS (SELECT nation, day, actual, CAST(NULL AS DOUBLE) AS pred FROM s WHERE is_train
      UNION ALL
      SELECT s.nation, s.day, s.actual, m.mean FROM s LEFT JOIN m ON s.nation = m.nation WHERE NOT s.is_train)
SELECT nation, row_number() OVER (PARTITION BY nation ORDER BY day) AS pos, day,
       ROUND(actual, 6) AS actual, ROUND(pred, 6) AS pred, pred IS NULL AS is_history
FROM u
"""

ORACLE["csv_roundtrip"] = f"""
WITH {_GAPS}
SELECT c_custkey, COALESCE(seg, '') AS seg, COALESCE(bal, 0.0) AS bal, COALESCE(nat, 0) AS nat FROM g
"""

_PROFILES = """
log AS (SELECT event_id, user_id, json_extract_string(props, '$.k') AS item,
               CAST(event_type = 'purchase' AS INTEGER) AS target FROM events),
u AS (SELECT user_id, CAST(count(target) AS DOUBLE) AS user_clicks, avg(target) AS user_pplrty FROM log GROUP BY user_id),
i AS (SELECT item, CAST(count(target) AS DOUBLE) AS item_clicks, avg(target) AS item_pplrty FROM log GROUP BY item)
"""

ORACLE["stream_score"] = f"""
WITH {_PROFILES}
SELECT log.event_id, log.user_id, log.item, COALESCE(u.user_clicks, 0.0) AS user_clicks,
       COALESCE(i.item_clicks, 0.0) AS item_clicks,
       ROUND((COALESCE(u.user_pplrty, 0.0) + COALESCE(i.item_pplrty, 0.0)) / 2, 6) AS score
FROM log LEFT JOIN u ON log.user_id = u.user_id LEFT JOIN i ON log.item = i.item
"""

ORACLE["stream_vocab"] = """
SELECT label, count(*) AS freq FROM (SELECT json_extract_string(props, '$.k') AS label FROM events)
WHERE label IS NOT NULL AND label <> '' GROUP BY label
"""

ORACLE["stream_json"] = f"""
WITH {_PROFILES}
SELECT e.event_id, ROUND(COALESCE(u.user_pplrty, 0.0), 6) AS user_pplrty
FROM events e LEFT JOIN u ON e.user_id = u.user_id
"""


ORACLE["vocab_sizes"] = f"""
WITH {_LINEITEM_LOG},
j AS (SELECT log.*, p.p_brand, p.p_type, string_split(p.p_name, ' ') AS tokens
      FROM log LEFT JOIN part p ON log.l_partkey = p.p_partkey),
s AS (SELECT 'l_linestatus' AS feature, l_linestatus AS label FROM j
      UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM j
      UNION ALL SELECT 'p_brand', p_brand FROM j
      UNION ALL SELECT 'p_type', p_type FROM j
      UNION ALL SELECT 'tokens', unnest(tokens) FROM j)
SELECT feature, count(DISTINCT label) AS n_unique FROM s WHERE label IS NOT NULL AND label <> '' GROUP BY feature
"""

ORACLE["distinct_users"] = f"WITH {_LINEITEM_LOG} SELECT DISTINCT o_custkey FROM log"

ORACLE["tick_order"] = """
WITH c AS (SELECT CAST(c_nationkey AS VARCHAR) AS code, count(*) AS cnt FROM customer GROUP BY 1)
SELECT code, cnt, row_number() OVER (ORDER BY TRY_CAST(code AS BIGINT) NULLS LAST, code) AS tick FROM c
"""


ORACLE["union_history"] = """
WITH r AS (SELECT o_orderkey, o_custkey, o_orderdate,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ra,
                  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
s AS (SELECT *, CASE WHEN ra <= n - floor(n * CAST(0.3 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split FROM r),
u AS (SELECT * FROM s WHERE split = 'train' UNION ALL SELECT * FROM s WHERE split = 'valid')
SELECT o_orderkey, o_custkey, split,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos FROM u
"""


from featurelane.plans.oracle_flows import FLOWS  # noqa: E402

ORACLE |= FLOWS


def _stable_round(sql: str) -> str:
    """Rewrite every ``ROUND(expr, 6)`` as decimal rounding (same rule as the Spark side)."""
    out, i, key = [], 0, "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        head, sep, digits = inner.rpartition(",")
        if sep and digits.strip() == "6":
            value = _stable_round(head)
            out.append(f"COALESCE(CAST(ROUND(TRY_CAST({value} AS DECIMAL(38,9)), 6) AS DOUBLE), {value})")
        else:
            out.append(key + _stable_round(inner) + ")")
        i = k


ORACLE = {k: _stable_round(v) for k, v in ORACLE.items()}
