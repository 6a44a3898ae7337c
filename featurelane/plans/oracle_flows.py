"""DuckDB SQL of the flow queries."""

FLOWS: dict[str, str] = {}

# ---------------------------------------------------------------- hashing


def _bucket(key: str, buckets: int) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 15))::BIGINT % {buckets} AS INTEGER)"


def _cross(cols: list[str], buckets: int = 10000) -> str:
    parts = [f"length(coalesce({c}::VARCHAR, '')) || ':' || coalesce({c}::VARCHAR, '')" for c in cols]
    return _bucket(" || ".join(parts), buckets)


FLOWS["hash_cross"] = f"""
SELECT o_orderkey, {_bucket("o_custkey::VARCHAR", 2000)} AS cust_bucket,
       {_cross(["o_orderpriority", "o_orderstatus"])} AS cross_bucket,
       CAST(o_orderstatus = 'F' AS INTEGER) AS status_0, CAST(o_orderstatus = 'O' AS INTEGER) AS status_1,
       CAST(o_orderstatus = 'P' AS INTEGER) AS status_2,
       CASE WHEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) BETWEEN 0 AND 4
            THEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS prio_ident
FROM orders
"""

FLOWS["shuffle_buffers"] = """
SELECT o_orderkey, o_custkey, CAST(('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 16 AS INTEGER) AS buffer,
       row_number() OVER (PARTITION BY ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 16 ORDER BY md5('42|' || o_orderkey), o_orderkey) AS pos
FROM orders
"""

FLOWS["split_separator"] = """
SELECT o_orderkey, (unnest(range(len(p))))::INTEGER AS pos, unnest(p) AS part
FROM (SELECT o_orderkey, list_transform(string_split(o_orderpriority || ' - ' || o_orderstatus, '-'), lambda x: trim(x)) AS p FROM orders)
"""

FLOWS["concat_features"] = """
SELECT user_id, unnest([0, 1, 2, 3]) AS pos, ROUND(unnest([n, m, n * m, m * n]), 6) AS x
FROM (SELECT user_id, count(*)::DOUBLE AS n, avg((event_type = 'purchase')::INTEGER) AS m FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
"""

# ---------------------------------------------------------------- daily sales (B)

_SALES = """
daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, sum(l_extendedprice * (1 - l_discount)) AS rev, avg(l_discount) AS disc
  FROM lineitem GROUP BY ALL),
log AS (
  SELECT CAST(l_suppkey AS INTEGER) AS store, d, strftime(d, '%Y-%m-%d') AS date, CAST(dayofweek(d) + 1 AS VARCHAR) AS day_of_week,
         CASE WHEN dayofweek(d) = 0 THEN '0' ELSE '1' END AS open, CASE WHEN dayofweek(d) = 0 THEN 0.0 ELSE rev END AS sales,
         CASE WHEN round(disc, 6) > 0.05 THEN '1' ELSE '0' END AS promo, '0' AS state_holiday, '0' AS school_holiday
  FROM daily),
shops AS (
  SELECT CAST(s_suppkey AS INTEGER) AS store, ['a', 'b', 'c', 'd'][CAST(s_nationkey % 4 + 1 AS INTEGER)] AS store_type,
         ['a', 'b', 'c'][CAST(s_suppkey % 3 + 1 AS INTEGER)] AS assortment, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS distance,
         CASE WHEN s_acctbal >= 0 THEN s_suppkey % 12 + 1 END AS since_month, CASE WHEN s_acctbal >= 0 THEN s_nationkey % 10 + 2000 END AS since_year,
         s_nationkey % 2 = 0 AS promoted, s_suppkey % 52 + 1 AS week, n_name AS state,
         [[1, 4, 7, 10], [2, 5, 8, 11], [3, 6, 9, 12]][CAST(s_nationkey % 3 + 1 AS INTEGER)] AS months
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
since AS (SELECT *, CAST(make_date(since_year::BIGINT, since_month::BIGINT, 1) - DATE '1970-01-01' AS DOUBLE) AS since_days FROM shops),
medians AS (SELECT quantile_cont(distance, 0.5) AS m_distance, quantile_cont(since_days, 0.5) AS m_since FROM since),
stores AS (
  SELECT *, coalesce(distance, m_distance) AS competition_distance, coalesce(since_days, m_since) AS competition_open_since,
         coalesce(since_month::VARCHAR, '') AS competition_open_since_month, coalesce(since_year::VARCHAR, '') AS competition_open_since_year,
         CAST(DATE '2005-01-01' - DATE '1970-01-01' + 7 * week AS DOUBLE) AS promo2since, week::VARCHAR AS promo2since_week, '2005' AS promo2since_year
  FROM since CROSS JOIN medians),
places AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY date) AS ra, count(*) OVER (PARTITION BY store) AS n
           FROM log WHERE open = '1' AND sales > 0),
parts AS (SELECT store, date, CASE WHEN ra <= n - floor(n * CAST(0.3 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split FROM places),
means AS (SELECT store, avg(sales) AS sales_mean FROM log JOIN parts USING (store, date) WHERE split = 'train' GROUP BY store),
full_log AS (
  SELECT l.store, l.date, day_of_week, open, CASE WHEN promoted AND list_contains(months, month(d)) THEN '1' ELSE '0' END AS promo2,
         promo, state_holiday, school_holiday, store_type, assortment, state, year(d)::VARCHAR AS year, month(d)::VARCHAR AS month, day(d)::VARCHAR AS day,
         coalesce(sales_mean, 0.0) AS sales_mean, competition_distance, competition_open_since, competition_open_since_month,
         competition_open_since_year, promo2since, promo2since_week, promo2since_year, sales
  FROM log l JOIN stores USING (store) LEFT JOIN means USING (store)),
prepared AS (SELECT f.* REPLACE (ln(1 + sales) AS sales), split FROM full_log f JOIN parts USING (store, date)),
stats AS (
  SELECT avg(sales_mean) AS m1, stddev_samp(sales_mean) AS s1, avg(competition_distance) AS m2, stddev_samp(competition_distance) AS s2,
         avg(competition_open_since) AS m3, stddev_samp(competition_open_since) AS s3, avg(promo2since) AS m4, stddev_samp(promo2since) AS s4
  FROM prepared WHERE split = 'train')
"""

FLOWS["sales_prepared"] = f"""
WITH {_SALES}
SELECT p.* REPLACE (ROUND((sales_mean - m1) / s1, 6) AS sales_mean, ROUND((competition_distance - m2) / s2, 6) AS competition_distance,
                    ROUND((competition_open_since - m3) / s3, 6) AS competition_open_since, ROUND((promo2since - m4) / s4, 6) AS promo2since,
                    ROUND(sales, 6) AS sales)
FROM prepared p CROSS JOIN stats
"""

FLOWS["sales_crosses"] = f"""
WITH {_SALES}
SELECT store, date, {_cross(["promo", "promo2", "year", "month", "day", "day_of_week"])} AS promo_datetime_cross,
       {_cross(["promo", "promo2", "state", "state_holiday", "school_holiday"])} AS promo_holiday_cross,
       {_cross(["state", "store_type", "assortment", "day_of_week"])} AS store_type_cross,
       {_cross(["competition_open_since_month", "competition_open_since_year"])} AS competition_cross
FROM prepared
"""

FLOWS["sales_serving"] = f"""
WITH {_SALES}
SELECT * EXCLUDE (sales) REPLACE (ROUND(sales_mean, 6) AS sales_mean, ROUND(competition_distance, 6) AS competition_distance,
       ROUND(competition_open_since, 6) AS competition_open_since, ROUND(promo2since, 6) AS promo2since)
FROM full_log
"""

# a ridge on one scaled feature: slope Sxy / (Sxx + alpha), the intercept free
FLOWS["sales_stream"] = f"""
WITH {_SALES},
pairs AS (SELECT (sales_mean - m1) / s1 AS x, sales AS y FROM prepared CROSS JOIN stats WHERE split = 'train'),
fitted AS (SELECT covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + 0.5) AS w, avg(y) AS ym, avg(x) AS xm FROM pairs)
SELECT store, date, open, day_of_week, promo2, ROUND((sales_mean - m1) / s1, 6) AS sales_mean,
       CASE WHEN open = '1' THEN round_even(exp(ym + w * ((sales_mean - m1) / s1 - xm)) - 1, 0) ELSE 0.0 END AS pred
FROM full_log CROSS JOIN stats CROSS JOIN fitted
"""

# ---------------------------------------------------------------- interaction log (A)

_USER_HIST = {"l_linestatus": False, "o_orderstatus": False, "o_orderpriority": False, "p_brand": True, "language": True, "genres": True}
_ITEM_HIST = {"l_linestatus": False, "o_orderstatus": False, "o_orderpriority": False, "city": False, "c_mktsegment": True, "age_catg": True}
_ONE = ["o_custkey", "l_partkey", "l_linestatus", "o_orderstatus", "o_orderpriority", "city", "c_mktsegment", "age_catg", "p_brand", "language", "cc", "xxx"]


def _values(table: str, key: str, col: str) -> str:
    value = "unnest(genres)" if col == "genres" else f"{col}::VARCHAR"
    return f"SELECT {key} AS key, '{col}' AS feature, {value} AS v, target FROM {table}"


def _hist(owner: str, key: str, of: dict[str, bool]) -> str:
    means = ", ".join(f"'{c}'" for c, mean in of.items() if mean)
    return f"""
{owner}_values AS ({' UNION ALL '.join(_values("fat", key, c) for c in of)}),
{owner}_hist AS (
  SELECT key, feature, v, feature AS vocab, count(target)::DOUBLE AS cnt, CASE WHEN feature IN ({means}) THEN avg(target) END AS mean,
         row_number() OVER (PARTITION BY key, feature ORDER BY v) AS pos
  FROM {owner}_values WHERE key IS NOT NULL AND v IS NOT NULL GROUP BY key, feature, v)"""


def _long(owner: str, base: str, key: str, of: dict[str, bool], more: str = "") -> str:
    rows = ", ".join(f"('{c}', {str(mean).lower()})" for c, mean in of.items())
    return f"""
SELECT '{owner}' AS owner, b.{key} AS key, g.feature, coalesce(h.pos, 1)::INTEGER AS pos, coalesce(w.idx, 0)::INTEGER AS id, coalesce(h.cnt, 0.0) AS cnt,
       CASE WHEN h.key IS NULL AND g.mean THEN 0.0 ELSE h.mean END AS mean
FROM {base} b CROSS JOIN (VALUES {rows}) g(feature, mean)
LEFT JOIN (SELECT * FROM {owner}_hist{more}) h ON h.key = b.{key} AND h.feature = g.feature
LEFT JOIN vocab w ON w.col = h.vocab AND w.label = h.v"""


_A = f"""
log AS (
  SELECT o_custkey, l_partkey, l_orderkey, l_linenumber, l_shipdate, l_linestatus, o_orderstatus, o_orderpriority, (l_returnflag = 'R')::INTEGER AS target
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sizes AS (SELECT o_custkey, count(*) AS n FROM log GROUP BY o_custkey),
bounds AS (SELECT floor(quantile_cont(n, 0.25))::BIGINT AS lo, floor(quantile_cont(n, 0.75))::BIGINT AS hi FROM sizes),
ranked AS (SELECT log.*, n, row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rd
           FROM log JOIN sizes USING (o_custkey)),
parts AS (SELECT * EXCLUDE (n, rd, lo, hi), CASE WHEN least(n, hi) - rd + 1 <= floor(least(n, hi) * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS split
          FROM ranked CROSS JOIN bounds WHERE n >= lo AND rd <= least(n, hi)),
ages AS (SELECT *, floor(c_acctbal / 100)::INTEGER AS age FROM customer),
users AS (
  SELECT c_custkey AS o_custkey, c_nationkey::VARCHAR AS city, c_mktsegment,
         CASE WHEN age < 6 OR age >= 80 OR age IS NULL THEN '' WHEN age < 10 THEN '6-10' WHEN age < 20 THEN '10-20' WHEN age < 30 THEN '20-30'
              WHEN age < 40 THEN '30-40' WHEN age < 60 THEN '40-60' ELSE '60-80' END AS age_catg,
         CASE WHEN age BETWEEN 6 AND 80 THEN age ELSE (SELECT quantile_cont(age, 0.5) FROM ages WHERE age BETWEEN 6 AND 80) END::DOUBLE AS age_num,
         (DATE '1992-01-01' - DATE '1970-01-01' + c_custkey % 1000)::DOUBLE AS registered, (c_custkey * 7 % 900)::DOUBLE AS tenure FROM ages),
items AS (
  SELECT p_partkey AS l_partkey, p_brand, p_size::VARCHAR AS language, list_sort(list_prepend(p_type, string_split(p_name, ' '))) AS genres,
         'US' AS cc, substr(p_type, 1, 3) AS xxx, p_retailprice, (CASE WHEN p_size < 18 THEN 100 + p_size ELSE p_size END)::DOUBLE AS yy FROM part),
fat AS (SELECT p.*, u.* EXCLUDE (o_custkey), i.* EXCLUDE (l_partkey) FROM (SELECT * FROM parts WHERE split = 'train') p
        LEFT JOIN users u USING (o_custkey) LEFT JOIN items i USING (l_partkey)),
labels AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, {c}::VARCHAR AS label FROM fat" for c in _ONE)}
           UNION ALL SELECT 'genres', unnest(genres) FROM fat),
vocab AS (SELECT col, label, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) AS idx
          FROM labels WHERE label IS NOT NULL AND label <> '' GROUP BY col, label),
{_hist("user", "o_custkey", _USER_HIST)},
{_hist("item", "l_partkey", _ITEM_HIST)},
queries AS (
  SELECT o_custkey AS key, CASE target WHEN 1 THEN 'pos_query' ELSE 'neg_query' END AS feature, l_partkey::VARCHAR AS v, 'l_partkey' AS vocab,
         1.0::DOUBLE AS cnt, NULL::DOUBLE AS mean, row_number() OVER (PARTITION BY o_custkey, target ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS pos FROM fat),
profiles AS ({_long("user", "users", "o_custkey", _USER_HIST | {"pos_query": False, "neg_query": False}, " UNION ALL SELECT * FROM queries")}
             UNION ALL {_long("item", "items", "l_partkey", _ITEM_HIST)})
"""

FLOWS["interaction_profiles"] = f"""
WITH {_A}
SELECT owner, key, feature, pos, id, cnt, ROUND(mean, 6) AS mean FROM profiles
"""


def _wide(owner: str, of: dict[str, bool]) -> str:
    cols = []
    for c, mean in of.items():
        ids, n = f"max(CASE WHEN feature = '{c}' THEN ids END)", f"max(CASE WHEN feature = '{c}' THEN n END)::INTEGER"
        cols += [f"{ids} AS {owner}_{c}_hist", f"{n} AS {owner}_{c}_count"] + ([f"{n} AS {owner}_{c}_mean"] if mean else [])
    return f"SELECT key, {', '.join(cols)} FROM arrays WHERE owner = '{owner}' GROUP BY key"


def _id(col: str, value: str) -> str:
    return f"coalesce((SELECT idx FROM vocab w WHERE w.col = '{col}' AND w.label = {value}::VARCHAR), 0)::INTEGER AS {col}"


def _scaled(table: str, cols: list[str]) -> str:
    return ", ".join(f"({c} - (SELECT avg({c}) FROM {table})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM {table}) AS {c}" for c in cols)


FLOWS["interaction_flow"] = f"""
WITH {_A},
arrays AS (SELECT owner, key, feature, string_agg(id::VARCHAR, ',' ORDER BY pos) AS ids, count(*) AS n FROM profiles GROUP BY ALL),
ages_all AS (SELECT *, registered + tenure AS expires FROM users),
user_rows AS (
  SELECT o_custkey AS raw_o_custkey, {', '.join(_id(c, "u." + c) for c in ("o_custkey", "city", "c_mktsegment", "age_catg"))},
         {_scaled("ages_all", ["age_num", "registered", "expires", "tenure"])}
  FROM ages_all u),
clicks AS (SELECT l_partkey, count(target)::DOUBLE AS item_clicks, avg(target) AS item_pplrty FROM fat GROUP BY l_partkey),
per_item AS (
  SELECT items.*, coalesce(item_clicks, (SELECT quantile_cont(item_clicks, 0.5) FROM clicks)) AS item_clicks,
         coalesce(item_pplrty, (SELECT quantile_cont(item_pplrty, 0.5) FROM clicks)) AS item_pplrty FROM items LEFT JOIN clicks USING (l_partkey)),
per_row AS (SELECT item_clicks, item_pplrty FROM fat JOIN per_item USING (l_partkey)),
genre_ids AS (
  SELECT l_partkey, string_agg(coalesce(w.idx, 0)::VARCHAR, ',' ORDER BY k) AS genres
  FROM (SELECT l_partkey, unnest(genres) AS g, generate_subscripts(genres, 1) AS k FROM items) LEFT JOIN vocab w ON w.col = 'genres' AND w.label = g GROUP BY l_partkey),
item_rows AS (
  SELECT i.l_partkey AS raw_l_partkey, {', '.join(_id(c, "i." + c) for c in ("l_partkey", "p_brand", "language", "cc", "xxx"))}, g.genres,
         {_scaled("items", ["p_retailprice", "yy"])}, len(i.genres)::INTEGER AS n_genres, {_scaled("per_row", ["item_clicks", "item_pplrty"])}
  FROM per_item i JOIN genre_ids g USING (l_partkey))
SELECT p.o_custkey AS raw_o_custkey, p.l_partkey AS raw_l_partkey, target, l_orderkey, l_linenumber, split, u.* EXCLUDE (raw_o_custkey)
         REPLACE (ROUND(age_num, 6) AS age_num, ROUND(registered, 6) AS registered, ROUND(expires, 6) AS expires, ROUND(tenure, 6) AS tenure),
       a.* EXCLUDE (key), i.* EXCLUDE (raw_l_partkey)
         REPLACE (ROUND(p_retailprice, 6) AS p_retailprice, ROUND(yy, 6) AS yy, ROUND(item_clicks, 6) AS item_clicks, ROUND(item_pplrty, 6) AS item_pplrty),
       b.* EXCLUDE (key), {', '.join(_id(c, "p." + c) for c in ("l_linestatus", "o_orderstatus", "o_orderpriority"))}
FROM parts p JOIN user_rows u ON u.raw_o_custkey = p.o_custkey JOIN ({_wide("user", {"pos_query": False, "neg_query": False} | _USER_HIST)}) a ON a.key = p.o_custkey
JOIN item_rows i ON i.raw_l_partkey = p.l_partkey JOIN ({_wide("item", _ITEM_HIST)}) b ON b.key = p.l_partkey
"""
