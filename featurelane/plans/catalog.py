"""Registered queries over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame with flat scalar
columns (arrays exploded with their position) and floats rounded to 6 digits, so
results compare across engines.  The matching DuckDB SQL is in
:mod:`featurelane.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.operators import history as H
from featurelane.plans import flows
from featurelane.plans.common import _r, event_log, lineitem_log
from featurelane.sources.tables import Tables, spread


# ---------------------------------------------------------------- history (A1-A5)

def history_user_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + J5 + N4: per customer, items met with count and mean target."""
    t = Tables(spark, sf_dir)
    hist = H.history_long(event_log(t), "user_id", "item", "target")
    base = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    out = H.reindex_long(base, hist, "user_id", "item")
    return out.select("user_id", "c_mktsegment", "pos", "item", "cnt", _r(F.col("mean")).alias("mean_target"))


def history_user_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: multivalent history -- part-name tokens per customer (unnest then A1)."""
    t = Tables(spark, sf_dir)
    log = lineitem_log(t).join(t.part.select("p_partkey", F.split("p_name", " ").alias("tokens")),
                               F.col("l_partkey") == F.col("p_partkey"), "left")
    hist = H.history_long(log, "o_custkey", "tokens", "target", multivalent=True)
    base = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    out = H.reindex_long(base, hist, "o_custkey", "tokens")
    return out.select("o_custkey", "pos", F.col("tokens").alias("token"), "cnt",
                      _r(F.col("mean")).alias("mean_target"))


def pos_neg_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: positive / negative item lists per user in log order (ts, event_id)."""
    t = Tables(spark, sf_dir)
    log = event_log(t)
    lists = H.polarity_items(log, "user_id", "item", "target", ["ts", "event_id"])
    return H.polarity_defaults(log.select("user_id").distinct(), lists, "user_id", "item")


def item_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + N2: clicks / popularity per part, absent parts get the column median."""
    from featurelane.operators.clean import fill_median
    t = Tables(spark, sf_dir)
    pop = H.entity_popularity(lineitem_log(t), "l_partkey", "target", "item")
    parts = t.part.select("p_partkey").join(pop, F.col("p_partkey") == F.col("l_partkey"), "left")
    parts = fill_median(parts, ["item_clicks", "item_pplrty"])
    return parts.select("p_partkey", "item_clicks", _r(F.col("item_pplrty")).alias("item_pplrty"))


def history_multi_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2 over three features in one pass (stack -> one aggregation)."""
    t = Tables(spark, sf_dir)
    hist = H.unpivot_history(lineitem_log(t), "o_custkey",
                             ["l_linestatus", "o_orderstatus", "o_orderpriority"], "target")
    return hist.select("o_custkey", "feature", "pos", "value", "cnt", _r(F.col("mean")).alias("mean_target"))



# ---------------------------------------------------------------- splits

def activity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on events per user, ordered by (ts, event_id), 10% validation."""
    from featurelane.operators.split import activity_split as split
    t = Tables(spark, sf_dir)
    out = split(t.events.select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"], valid=0.1)
    return out.select("event_id", "user_id", "split")


def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on orders per customer, ordered by (o_orderdate, o_orderkey), 30% validation."""
    from featurelane.operators.split import chrono_split as split
    t = Tables(spark, sf_dir)
    out = split(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey",
                ["o_orderdate", "o_orderkey"], valid=0.3)
    return out.select("o_orderkey", "o_custkey", "split")


def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's 3 newest orders."""
    from featurelane.operators.split import latest_n as latest
    t = Tables(spark, sf_dir)
    out = latest(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey",
                 ["o_orderdate", "o_orderkey"], 3)
    return out.select("o_orderkey", "o_custkey", "rn")


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of events per user (describe)."""
    from featurelane.operators.split import size_distribution
    t = Tables(spark, sf_dir)
    d = size_distribution(t.events.select("user_id"), "user_id")
    return d.select(*[_r(F.col(c)).alias(c) for c in d.columns])


# ------------------------------------------------------------ encoders

def freq_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand ids by frequency in the lineitem log; transform the part table."""
    from featurelane.operators import encoders as E
    t = Tables(spark, sf_dir)
    log = t.lineitem.select("l_partkey").join(t.part.select("p_partkey", "p_brand"),
                                              F.col("l_partkey") == F.col("p_partkey"))
    vocab = E.frequency_vocab(log, "p_brand")
    return E.encode(t.part.select("p_partkey", "p_brand"), "p_brand", vocab, "brand_id")


def sorted_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type ids by sorted label, over the part table."""
    from featurelane.operators import encoders as E
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", "p_type")
    return E.encode(parts, "p_type", E.sorted_vocab(parts, "p_type"), "type_id")


def array_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + R6: frequency vocabulary over name tokens; element-wise encode, order kept."""
    from featurelane.operators import encoders as E
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", F.split("p_name", " ").alias("tokens"))
    vocab = E.frequency_vocab(parts, "tokens", multivalent=True)
    out = E.encode_array_long(parts, ["p_partkey"], "tokens", vocab, "token_id")
    return out.select("p_partkey", "pos", F.col("tokens").alias("token"), "token_id")


def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E5: encode priorities, decode the ids back (unknown -> null)."""
    from featurelane.operators import encoders as E
    t = Tables(spark, sf_dir)
    od = t.orders.select("o_orderkey", "o_orderpriority")
    vocab = E.sorted_vocab(od, "o_orderpriority")
    enc = E.encode(od, "o_orderpriority", vocab, "prio_id")
    dec = E.decode(enc.withColumn("next_id", F.col("prio_id") + 1), "next_id", vocab, "next_label")
    dec = E.decode(dec, "prio_id", vocab, "decoded")
    return dec.select("o_orderkey", "prio_id", "decoded", "next_label")


def standardize_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill median, (x - mean) / population std; negative balances count as missing."""
    from featurelane.operators.encoders import fit_scaler
    t = Tables(spark, sf_dir)
    cust = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"))
    model = fit_scaler(cust, ["acctbal"], ddof=0)
    return model.transform(cust).select("c_custkey", _r(F.col("acctbal")).alias("acctbal_z"))


def standardize_samp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x - mean) / sample std."""
    from featurelane.operators.encoders import fit_scaler
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", "p_retailprice", "p_size")
    model = fit_scaler(parts, ["p_retailprice", "p_size"], ddof=1)
    out = model.transform(parts)
    return out.select("p_partkey", _r(F.col("p_retailprice")).alias("price_z"), _r(F.col("p_size")).alias("size_z"))



# ---------------------------------------------------- cleaning and scalars (N*, F*, R*)

def multivalue_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise whole document texts into sorted pipe-separated values."""
    from featurelane.functions.text import multivalue_clean as clean
    t = Tables(spark, sf_dir)
    docs = spread(t.documents).select("doc_id", clean("text").alias("vals"))
    docs = docs.select("doc_id", F.size("vals").alias("n_vals"), "vals")
    out = H.unnest(docs, "vals", ["doc_id", "n_vals"], pos="pos")
    return out.select("doc_id", "n_vals", "pos", F.col("vals").alias("val"))


def entity_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 over whole raw pages: digest and length of the unescaped html."""
    from featurelane.functions.text import html_unescape
    t = Tables(spark, sf_dir)
    u = spread(t.pages).select("page_id", html_unescape("html").alias("u"))
    return u.select("page_id", F.length("u").alias("n_chars"), F.md5("u").alias("md5"))


def longest_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 longest multivalent elements (top-k is the feature)."""
    from featurelane.functions.text import multivalue_clean as clean
    t = Tables(spark, sf_dir)
    el = spread(t.documents).select(F.explode_outer(clean("text")).alias("val")).where(F.col("val").isNotNull())
    el = el.select(F.length("val").alias("n_chars"), F.md5("val").alias("md5"))
    return el.orderBy(F.col("n_chars").desc(), F.col("md5")).limit(10)


def code_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code normaliser, fixed-position parts, two-digit year + median fill."""
    from featurelane.functions.codes import code_norm, code_parts, two_digit_year
    from featurelane.operators.clean import fill_median
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_acctbal", F.substring("c_name", 10, 9).alias("code"))
    c = c.select("c_custkey", code_norm(F.col("c_acctbal").cast("string")).alias("acct_code"),
                 *code_parts("code", {"cc": (1, 2), "xxx": (3, 3)}),
                 two_digit_year(F.substring("code", 6, 2)).cast("double").alias("yy"))
    c = fill_median(c, ["yy"])
    return c.withColumn("yy", F.col("yy") - 1900)


def bucket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """left-closed bins with labels (age rule on p_size; balance bands)."""
    from featurelane.functions.codes import age_buckets, bucket_labels as buckets
    t = Tables(spark, sf_dir)
    bins, labels = age_buckets()
    parts = t.part.select("p_partkey", buckets("p_size", bins, labels).alias("size_catg"))
    cust = t.customer.select(F.col("c_custkey").alias("p_partkey"),
                             buckets("c_acctbal", [0, 1000, 5000], ["neg", "0-1k", "1k-5k", "5k+"]).alias("size_catg"))
    return parts.withColumn("src", F.lit("part")).unionByName(cust.withColumn("src", F.lit("customer")))


def date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yyyymmdd -> epoch days, date parts, month / year starts, tenure years."""
    from featurelane.functions import dates as D
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderdate",
                        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ymd"))
    o = o.select("o_orderkey", D.yyyymmdd_to_days("ymd").alias("days"), *D.date_parts("o_orderdate"))
    o = o.withColumn("month_start", D.year_month_days("year", "month").cast("long"))
    o = o.withColumn("year_start", D.year_week_days("year").cast("long"))
    o = o.withColumn("tenure_years", D.years_half_even(D.days_between("days", F.lit(8035.0))))
    return o


def range_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes outside [6, 40] replaced by the median of the in-range sizes."""
    from featurelane.operators.clean import range_median as fix
    t = Tables(spark, sf_dir)
    p = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"))
    return fix(p, "size", 6, 40)


def fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns with missing values filled by their exact medians (one pass)."""
    from featurelane.operators.clean import fill_median as fill
    t = Tables(spark, sf_dir)
    p = t.part.select("p_partkey",
                      F.when(F.col("p_size") >= 10, F.col("p_retailprice")).alias("price"),
                      F.when(F.col("p_size") <= 45, F.col("p_size").cast("double")).alias("size"))
    return fill(p, ["price", "size"])


def _customer_gaps(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey",
                             F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"),
                             F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
                             F.when(F.col("c_nationkey") != 0, F.col("c_nationkey")).alias("nat"))


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema defaults -- '' for categoricals, median for numerics, 0 for ids."""
    from featurelane.operators.clean import fill_defaults as fill
    t = Tables(spark, sf_dir)
    out = fill(_customer_gaps(t), {"seg": "", "bal": "median", "nat": 0})
    return out.select("c_custkey", "seg", _r(F.col("bal")).alias("bal"), "nat")


def missing_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of missing ('' or null) per column."""
    from featurelane.operators.clean import missing_fraction as frac
    t = Tables(spark, sf_dir)
    out = frac(_customer_gaps(t), ["seg", "bal", "nat"])
    return out.select(*[_r(F.col(c)).alias(c) for c in out.columns])


def unnest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unnest name tokens, value_counts, with mean list length per token."""
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", F.split("p_name", " ").alias("tokens"))
    parts = parts.withColumn("n_tokens", F.size("tokens"))
    flat = H.unnest(parts, "tokens", ["p_partkey", "n_tokens"])
    return flat.groupBy(F.col("tokens").alias("token")).agg(
        F.count(F.lit(1)).alias("cnt"), _r(F.avg("n_tokens")).alias("mean_len"))


def interval_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order month inside the month list chosen by priority, only for open orders."""
    from featurelane.functions.arrays import interval_flag as flag
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    interval = (F.when(F.col("o_orderpriority") == "1-URGENT", "Jan,Apr,Jul,Oct")
                 .when(F.col("o_orderpriority") == "2-HIGH", "Feb,May,Aug,Nov")
                 .when(F.col("o_orderpriority") == "3-MEDIUM", "Mar,Jun,Sept,Dec"))
    promo = F.when(F.col("o_orderstatus") == "O", "1").otherwise("0")
    return o.select("o_orderkey", flag(promo, F.month("o_orderdate"), interval).alias("promo_flag"))



# ------------------------------------------------------------ joins

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def fat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log x encoded user profile x encoded item profile."""
    from featurelane.operators import encoders as E
    from featurelane.operators.joins import fat_join
    t = Tables(spark, sf_dir)
    log = lineitem_log(t).select("l_orderkey", "l_linenumber", "o_custkey", "l_partkey", "target")
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
                             F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"))
    cust = E.encode(cust, "c_mktsegment", E.sorted_vocab(cust, "c_mktsegment"), "seg_id")
    cust_scaler = E.fit_scaler(cust, ["acctbal"], ddof=0)          # users' numerics: users table
    cust = cust_scaler.transform(cust).select("o_custkey", "seg_id", "acctbal")
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    part = E.encode(part, "p_brand", E.sorted_vocab(part, "p_brand"), "brand_id")
    part_scaler = E.fit_scaler(part, ["p_retailprice"], ddof=0)    # items' numerics: items table
    part = part_scaler.transform(part).select("l_partkey", "brand_id", "p_retailprice")
    fat = fat_join(log, cust, part, "o_custkey", "l_partkey")
    z = lambda m, c: (m.stats[c]["median"] - m.stats[c]["mean"]) / m.stats[c]["std"]
    fat = fat.na.fill({"seg_id": 0, "brand_id": 0, "acctbal": z(cust_scaler, "acctbal"),
                       "p_retailprice": z(part_scaler, "p_retailprice")})
    return fat.select("raw_o_custkey", "raw_l_partkey", "l_orderkey", "l_linenumber", "seg_id",
                      _r(F.col("acctbal")).alias("acctbal_z"), "brand_id",
                      _r(F.col("p_retailprice")).alias("price_z"), "target")


def _part_counts(t: Tables) -> DataFrame:
    from featurelane.operators.explore import value_counts
    return value_counts(t.lineitem, "l_partkey")


def semi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems of the 20 most frequent parts (semi-join to a computed top-k key list)."""
    from featurelane.operators.explore import top_k
    from featurelane.operators.joins import semi_join
    t = Tables(spark, sf_dir)
    top = top_k(_part_counts(t), [F.col("cnt").desc(), F.col("l_partkey")], 20).select("l_partkey")
    return semi_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), top, "l_partkey")


def semi_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``isin`` on two keys, ANDed (two semi-joins)."""
    from featurelane.operators.joins import semi_join
    t = Tables(spark, sf_dir)
    parts = t.part.where(F.col("p_size") >= 40).select(F.col("p_partkey").alias("l_partkey"))
    supps = t.supplier.where(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("l_suppkey"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return semi_join(semi_join(li, parts, "l_partkey"), supps, "l_suppkey")


def having_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with at least 35 lineitems."""
    from featurelane.operators.explore import having_count
    t = Tables(spark, sf_dir)
    return having_count(t.lineitem, ["l_partkey"], 35)


def topk_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity ranks 2..30 (``[1:30]``), ties by key."""
    from pyspark.sql import Window
    from featurelane.operators.explore import top_k
    t = Tables(spark, sf_dir)
    order = [F.col("cnt").desc(), F.col("l_partkey")]
    top = top_k(_part_counts(t), order, 29, offset=1)
    # ranking the 29 kept rows: a window over a bounded, already-limited set
    return top.withColumn("rank", (F.row_number().over(Window.orderBy(*order)) + 1).cast("long"))


def group_mean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order carries its customer's mean order value."""
    from featurelane.operators.joins import group_stat_rows
    t = Tables(spark, sf_dir)
    out = group_stat_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"],
                          "o_totalprice", "cust_mean")
    return out.select("o_orderkey", "o_custkey", _r(F.col("cust_mean")).alias("cust_mean"))


# ----------------------------------------------------------------- exploration

def _orders_customers(t: Tables) -> DataFrame:
    od = t.orders.select("o_custkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("target"),
                         "o_orderstatus")
    return od.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")


def pivot_mean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean target and row count per segment x priority (fixed ticks), empty -> 0."""
    from featurelane.operators.explore import pivot_mean_count as pivot
    t = Tables(spark, sf_dir)
    pv = pivot(_orders_customers(t), "c_mktsegment", "o_orderpriority", "target", PRIORITIES)
    cols = [F.col("c_mktsegment")]
    for p in PRIORITIES:
        cols += [_r(F.col(f"`{p}_mean`")).alias(f"mean_{_safe(p)}"), F.col(f"`{p}_count`").alias(f"count_{_safe(p)}")]
    return pv.select(*cols)


def facet_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count pivot of status x priority, one facet per segment."""
    from featurelane.operators.explore import pivot_count
    t = Tables(spark, sf_dir)
    pv = pivot_count(_orders_customers(t), "o_orderstatus", "o_orderpriority", PRIORITIES, facet=["c_mktsegment"])
    return pv.select("c_mktsegment", "o_orderstatus", *[F.col(f"`{p}`").alias(f"cnt_{_safe(p)}") for p in PRIORITIES])


def _rounded(df: DataFrame, keys) -> DataFrame:
    return df.select(*keys, *[_r(F.col(c)).alias(c) for c in df.columns if c not in keys])


def describe_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped describe of quantity per return flag, plus sum."""
    from featurelane.operators.explore import describe
    t = Tables(spark, sf_dir)
    return _rounded(describe(t.lineitem, "l_quantity", ["l_returnflag"]), ["l_returnflag"])


def describe_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Describe of order value over the whole table."""
    from featurelane.operators.explore import describe
    t = Tables(spark, sf_dir)
    return _rounded(describe(t.orders, "o_totalprice"), [])


def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot statistics of price per (flag, status)."""
    from featurelane.operators.explore import box_stats as box
    t = Tables(spark, sf_dir)
    return _rounded(box(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice"),
                    ["l_returnflag", "l_linestatus", "n_outliers"])


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 equal-width bins of price per return flag."""
    from featurelane.operators.explore import histogram as hist
    t = Tables(spark, sf_dir)
    return _rounded(hist(t.lineitem, ["l_returnflag"], "l_extendedprice", 10), ["l_returnflag", "bin", "cnt"])


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlations of the lineitem measures (long form)."""
    from featurelane.operators.explore import corr_matrix as corr
    t = Tables(spark, sf_dir)
    out = corr(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("col_a", "col_b", _r(F.col("corr")).alias("corr"))


def trend_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line of part return rate on popularity rank, ranks 2..100."""
    from featurelane.operators.explore import trend_line as line
    from featurelane.operators.ordered import number_within
    t = Tables(spark, sf_dir)
    pop = H.entity_popularity(lineitem_log(t), "l_partkey", "target", "item")
    ranked = number_within(pop, [], [F.col("item_clicks").desc(), F.col("l_partkey")], "rank")
    out = line(ranked.where(F.col("rank").between(2, 100)), "item_pplrty", "rank")
    return _rounded(out, ["n"])


# ------------------------------------------------------- batches, hashing, pooling (W5, W6, E*, R8-R11)

def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5/W6 + R6: encode whole conversation turns, 64-row batches, zero-pad per batch."""
    from featurelane.operators import encoders as E
    from featurelane.operators.multivalue import batches, pad_in_batch
    t = Tables(spark, sf_dir)
    conv = spread(t.conversations).select("conv_id", "turn", F.split("text", " ").alias("toks"))
    vocab = E.frequency_vocab(conv, "toks", multivalent=True)
    enc = E.encode_array(conv, ["conv_id", "turn"], "toks", vocab, "ids")
    padded = pad_in_batch(batches(enc, ["conv_id", "turn"], 64), "ids")
    out = padded.select("conv_id", "turn", "batch_id", F.posexplode("ids").alias("pos", "token_id"))
    return out.withColumn("pos", (F.col("pos") + 1).cast("long"))


def hash_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash bucket, hashed cross, fixed one-hot, identity bucket (rows-only check)."""
    from featurelane.operators import encoders as E
    t = Tables(spark, sf_dir)
    o = t.orders
    return o.select("o_orderkey", E.hash_bucket("o_custkey", 2000).alias("cust_bucket"),
                    E.hashed_cross(["o_orderpriority", "o_orderstatus"], 10000).alias("cross_bucket"),
                    *E.one_hot_fixed("o_orderstatus", ["F", "O", "P"], "status"),
                    E.identity_bucket(F.substring("o_orderpriority", 1, 1), 5).alias("prio_ident"))


def _emb(t: Tables) -> DataFrame:
    from featurelane.operators.pooling import vectors_long
    return vectors_long(t.embeddings, "vec_id", "embedding")


def _pool_weighted(t: Tables) -> DataFrame:
    from featurelane.operators.pooling import weighted_pool
    hist = H.value_stats(event_log(t), "user_id", "item", "target", ("count",))
    return weighted_pool(hist, ["user_id"], "item", "cnt", _emb(t))


def _pool_positive(t: Tables) -> DataFrame:
    from featurelane.operators.pooling import mean_sqrt_pool
    pos = event_log(t).where(F.col("target") == 1)
    return mean_sqrt_pool(pos, ["user_id"], "item", _emb(t))


def pooling_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count-weighted (L2-normalised) pooled item vector per user."""
    out = _pool_weighted(Tables(spark, sf_dir))
    return out.select("user_id", "dim", _r(F.col("x")).alias("x"))


def pooling_mean_sqrt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of positive-item vectors / sqrt(list length) per user."""
    out = _pool_positive(Tables(spark, sf_dir))
    return out.select("user_id", "dim", _r(F.col("x")).alias("x"))


def vector_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element-wise product of the two pooled user vectors."""
    from featurelane.operators.pooling import vector_product as prod
    t = Tables(spark, sf_dir)
    out = prod(_pool_weighted(t), _pool_positive(t), ["user_id"])
    return out.select("user_id", "dim", _r(F.col("x")).alias("x"))


# -------------------------------------------------------------------- metrics

def metrics_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price predicted by the part's mean price -- RMSPE (positive targets), RMSE, MAE."""
    from featurelane.operators.joins import group_stat_rows
    from featurelane.operators.metrics import regression_metrics
    t = Tables(spark, sf_dir)
    pred = group_stat_rows(t.lineitem.select("l_partkey", "l_extendedprice"), ["l_partkey"], "l_extendedprice", "pred")
    return _rounded(regression_metrics(pred, "l_extendedprice", "pred"), [])


def _scored_docs(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", "quality").join(t.documents.select("doc_id", "n_chars"), "doc_id")


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC (rank formula, ties half) and log-loss of a standardised length logit."""
    from featurelane.operators.encoders import fit_scaler
    from featurelane.operators.metrics import auc, log_loss_from_logits
    from featurelane.operators.split import _one_row_merge
    t = Tables(spark, sf_dir)
    d = _scored_docs(t)
    z = fit_scaler(d, ["n_chars"], ddof=0, fill_median=False).transform(d, ["n_chars"], suffix="_z")
    out = _one_row_merge(auc(d, "quality", "n_chars"), log_loss_from_logits(z, "quality", "n_chars_z"))
    return _rounded(out, [])


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: ROC points, one per distinct score."""
    from featurelane.operators.metrics import roc_points
    out = roc_points(_scored_docs(Tables(spark, sf_dir)), "quality", "n_chars")
    return _rounded(out, [])


# ------------------------------------------------------------- series

def series_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value per nation; last 30% of days predicted by the
    nation's training mean; history and predictions unioned in date order."""
    from featurelane.operators.explore import union_series
    from featurelane.operators.split import chrono_split
    t = Tables(spark, sf_dir)
    od = t.orders.select("o_custkey", "o_totalprice", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    cu = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    daily = od.join(cu, "o_custkey").groupBy("nation", "day").agg(
        F.sum(F.col("o_totalprice").cast("decimal(38,10)")).cast("double").alias("actual"))  # exact sum
    split = chrono_split(daily, "nation", ["day"], valid=0.3)
    train = split.where(F.col("split") == "train")
    mean = train.groupBy("nation").agg(F.avg("actual").alias("pred"))
    pred = split.where(F.col("split") == "valid").join(mean, "nation", "left").select("nation", "day", "actual", "pred")
    series = union_series(train.select("nation", "day", "actual"), pred, "nation", ["day"])
    return series.select("nation", "pos", "day", _r(F.col("actual")).alias("actual"), _r(F.col("pred")).alias("pred"),
                         "is_history")




def union_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chronological split's two parts unioned back (union all), each row
    tagged with its part and its position in the customer's history."""
    from featurelane.operators.ordered import number_within
    from featurelane.operators.split import chrono_split
    t = Tables(spark, sf_dir)
    s = chrono_split(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey",
                     ["o_orderdate", "o_orderkey"], valid=0.3)
    both = s.where(F.col("split") == "train").unionByName(s.where(F.col("split") == "valid"))
    out = number_within(both, ["o_custkey"], ["o_orderdate", "o_orderkey"], "pos")
    return out.select("o_orderkey", "o_custkey", "split", "pos")


# ------------------------------------------------------------------ sources

def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write customers as CSV (header, no index), read back with a
    declared schema and per-column defaults for empty fields, persist that as a
    stage table and read the stage table back."""
    from featurelane.sources import io
    from featurelane.streaming.serve import work_dir
    t = Tables(spark, sf_dir)
    path = io.resolve(work_dir(spark, "csv"), "customer")
    cust = _customer_gaps(t)
    io.write_csv(cust, path)
    schema = {"c_custkey": "bigint", "seg": "string", "bal": "double", "nat": "int"}
    back = io.read_csv(spark, path, schema, defaults={"seg": "", "bal": 0.0, "nat": 0})
    assert io.preview(spark, path, 3).count() <= 3
    stage = io.resolve(work_dir(spark, "stage"), "customer")
    io.write_table(back, stage)
    return io.read_table(spark, stage)


# ---------------------------------------------------------------- streaming

def _profiles(t: Tables):
    log = event_log(t)
    users = H.entity_popularity(log, "user_id", "target", "user")
    items = H.entity_popularity(log, "item", "target", "item")
    return users, items


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream scored against saved user / item profiles (stateless)."""
    from featurelane.streaming.serve import read_stream, run_append, score_stream
    t = Tables(spark, sf_dir)
    users, items = _profiles(t)
    src = read_stream(spark, f"{sf_dir}/events.parquet", t.events.schema)
    rec = src.select("event_id", "user_id", F.get_json_object("props", "$.k").alias("item"))
    scored = score_stream(rec, [(users, "user_id"), (items, "item")],
                          {"user_clicks": 0.0, "user_pplrty": 0.0, "item_clicks": 0.0, "item_pplrty": 0.0},
                          lambda d: d.withColumn("score", (F.col("user_pplrty") + F.col("item_pplrty")) / 2))
    out = run_append(scored, spark, "score")
    return out.select("event_id", "user_id", "item", "user_clicks", "item_clicks",
                      _r(F.col("score")).alias("score"))


def stream_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running item counts over the event stream (complete-mode state)."""
    from featurelane.streaming.serve import read_stream, vocab_counts_stream
    t = Tables(spark, sf_dir)
    src = read_stream(spark, f"{sf_dir}/events.parquet", t.events.schema)
    return vocab_counts_stream(src.select(F.get_json_object("props", "$.k").alias("item")), "item", spark)


def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON record payloads in, parsed and scored, JSON predictions out."""
    from pyspark.sql.types import StructType
    from featurelane.streaming.serve import json_records, read_stream, run_append, to_json_payload, work_dir
    t = Tables(spark, sf_dir)
    inbox = work_dir(spark, "inbox")
    t.events.select(F.to_json(F.struct("event_id", "user_id", "value", "props")).alias("value")) \
        .write.mode("overwrite").text(inbox)
    schema = StructType.fromDDL("event_id bigint, user_id bigint, value double, props string")
    src = read_stream(spark, inbox, StructType.fromDDL("value string"), fmt="text")
    rec = json_records(src, schema, "value")
    users, _ = _profiles(t)
    scored = rec.join(users, "user_id", "left").na.fill({"user_pplrty": 0.0})
    out = to_json_payload(scored, ["event_id", "user_pplrty"], "prediction")
    res = run_append(out, spark, "json")
    parsed = res.select(F.from_json("prediction", "event_id bigint, user_pplrty double").alias("p")).select("p.*")
    return parsed.select("event_id", _r(F.col("user_pplrty")).alias("user_pplrty"))


# --------------------------------------------------------------- models

def _orders_features(t: Tables) -> DataFrame:
    from featurelane.operators.encoders import fit_scaler
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
                        F.log1p("o_totalprice").alias("y"),
                        F.unix_date(F.to_date("o_orderdate")).cast("double").alias("days"),
                        F.month("o_orderdate").cast("double").alias("month"),
                        F.when(F.col("o_orderstatus") != "P", "1").otherwise("0").alias("open"))
    return fit_scaler(o, ["days", "month"], ddof=1).transform(o)


def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge on the chronological train part; closed orders predict 0."""
    from featurelane.operators.split import chrono_split
    from featurelane.plans import models as M
    t = Tables(spark, sf_dir)
    o = chrono_split(_orders_features(t), "o_custkey", ["o_orderdate", "o_orderkey"], valid=0.3)
    model = M.ridge(o.where(F.col("split") == "train"), "y", ["days", "month"], ["o_orderpriority", "o_orderstatus"],
                    categories=o)  # E14: dummies over train and valid categories
    return M.predict_sales(model, o, "open").select("o_orderkey", "split", "pred")


def _orders_split(t: Tables) -> DataFrame:
    """Order features with the chronological split, staged once for all passes of a fit."""
    from featurelane.operators.split import chrono_split
    from featurelane.session import cut_lineage
    crossed = _orders_features(t).withColumn("prio_x_status", F.concat_ws("_", "o_orderpriority", "o_orderstatus"))
    return cut_lineage(chrono_split(crossed, "o_custkey", ["o_orderdate", "o_orderkey"], valid=0.3))


def gbt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: gradient-boosted trees on the dense order features of the training part; both parts predicted."""
    from featurelane.plans import models as M
    o = _orders_split(Tables(spark, sf_dir))
    model = M.gbt_regressor(o.where(F.col("split") == "train"), "y", ["days", "month"], max_iter=10)
    return model.transform(o).select("o_orderkey", "split", _r(F.col("prediction")).alias("prediction"))


def wide_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear model over hashed categoricals and a hashed cross of the training part; both parts predicted."""
    from featurelane.plans import models as M
    o = _orders_split(Tables(spark, sf_dir))
    model = M.wide_linear(o.where(F.col("split") == "train"), "y", ["o_orderpriority", "o_orderstatus"], ["prio_x_status"], 10000)
    return model.transform(o).select("o_orderkey", "split", _r(F.col("prediction")).alias("prediction"))


def wide_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15 + M2/M3: wide (hashed, crossed) linear part plus boosted deep part on its residual; fitted on the training part."""
    from featurelane.plans import models as M
    o = _orders_split(Tables(spark, sf_dir))
    cols = {"days": "dense", "month": "dense", "o_orderpriority": "indicator",
            "o_orderstatus": "hashed", "prio_x_status": "cross"}
    model = M.wide_and_deep(o.where(F.col("split") == "train"), "y", cols)
    return model.transform(o).select("o_orderkey", "split", _r(F.col("prediction")).alias("prediction"))


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: binary classifier fitted on the fat table, every row scored."""
    from featurelane.plans import models as M
    from featurelane.session import cut_lineage
    fat = cut_lineage(fat_table(spark, sf_dir))  # stage end: fit and scoring read it once each
    model = M.classifier(fat, "target", ["acctbal_z", "price_z"], ids=["seg_id", "brand_id"])
    return M.probability(model.transform(fat)).select("l_orderkey", "l_linenumber", _r(F.col("prob")).alias("prob"))



def classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4/M9: classifier fitted on the activity-split training part of the fat
    table, AUC on training and validation rows (the reference's hold-out check)."""
    from featurelane.operators.metrics import auc
    from featurelane.operators.split import _one_row_merge, activity_split
    from featurelane.plans import models as M
    from featurelane.session import cut_lineage
    fat = fat_table(spark, sf_dir)
    t = Tables(spark, sf_dir)
    order = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    fat = fat.join(order, ["l_orderkey", "l_linenumber"])
    split = cut_lineage(activity_split(fat, "raw_o_custkey", ["l_shipdate", "l_orderkey", "l_linenumber"], valid=0.1))
    model = M.classifier(split.where(F.col("split") == "train"), "target", ["acctbal_z", "price_z"], ids=["seg_id", "brand_id"])
    scored = M.probability(model.transform(split))
    a_tr = auc(scored.where(F.col("split") == "train"), "target", "prob").withColumnRenamed("auc", "auc_train")
    a_vl = auc(scored.where(F.col("split") == "valid"), "target", "prob").withColumnRenamed("auc", "auc_valid")
    return _rounded(_one_row_merge(a_tr, a_vl), [])


def als_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: ALS factors over vocabulary ids, out of fold on the training part, with the user's mean; both parts scored."""
    from featurelane.operators.split import chrono_split
    from featurelane.plans import models as M
    from featurelane.plans.factors import out_of_fold_factors
    log = chrono_split(event_log(Tables(spark, sf_dir)), "user_id", ["ts", "event_id"], valid=0.3)
    train, valid = out_of_fold_factors(log.where(F.col("split") == "train"), log.where(F.col("split") == "valid"), "user_id", "item", "target", ["event_id"])
    model = M.classifier(train, "target", [f"mf_{i}" for i in range(8)] + ["user_mean"])
    return M.probability(model.transform(train.unionByName(valid))).select("event_id", "split", _r(F.col("prob")).alias("prob"))


def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 sampled strengths of an elastic net on the fixed chronological split, least RMSPE; the best model is saved and loaded."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.regression import LinearRegression

    from featurelane.plans import models as M
    from featurelane.plans.search import Search, search
    from featurelane.streaming.serve import work_dir
    o = _orders_split(Tables(spark, sf_dir))
    ids = [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in ("o_orderpriority", "o_orderstatus")]
    train, valid = o.where(F.col("split") == "train"), o.where(F.col("split") == "valid")
    prepared = Pipeline(stages=[*ids, *M.vectors(["days", "month"], [i.getOutputCol() for i in ids])]).fit(train)
    found = search(train, valid, "y", prepared, LinearRegression(labelCol="y"), {"regParam": ("log", 1e-4, 10.0), "elasticNetParam": ("linear", 0.0, 1.0)})
    base = work_dir(spark, "search")
    found.save(spark, base)
    best = Search.load(spark, base).best
    rows = [(i, t["params"]["regParam"], t["params"]["elasticNetParam"], t["value"], t == best) for i, t in enumerate(found.trials)]
    return spark.createDataFrame(rows, "trial int, reg double, mix double, rmspe double, best boolean")


def vocab_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary size per categorical of the fat log (tokens counted by element)."""
    from featurelane.operators.explore import vocabulary_sizes
    t = Tables(spark, sf_dir)
    log = lineitem_log(t).join(t.part.select("p_partkey", "p_brand", "p_type", F.split("p_name", " ").alias("tokens")),
                               F.col("l_partkey") == F.col("p_partkey"), "left")
    return vocabulary_sizes(log, ["l_linestatus", "o_orderpriority", "p_brand", "p_type"], ["tokens"])


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct users of the log (the base list histories are aligned to)."""
    from featurelane.operators.explore import distinct_keys
    return distinct_keys(lineitem_log(Tables(spark, sf_dir)), ["o_custkey"])


def tick_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation codes as strings, counted, ordered numerically."""
    from featurelane.operators.explore import numeric_tick_order, value_counts
    t = Tables(spark, sf_dir)
    codes = value_counts(t.customer.select(F.col("c_nationkey").cast("string").alias("code")), "code")
    return numeric_tick_order(codes, "code")


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: 100 lineitems drawn without replacement with a fixed seed (sampling is the feature)."""
    from featurelane.operators.explore import random_sample
    t = Tables(spark, sf_dir)
    return random_sample(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), 100, seed=42,
                         key=["l_orderkey", "l_linenumber"])


def split_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal separator with white space around it, one row per part."""
    from featurelane.functions.text import split_multi
    o = Tables(spark, sf_dir).orders
    parts = split_multi(F.concat_ws(" - ", "o_orderpriority", "o_orderstatus"), "-")
    return o.select("o_orderkey", F.posexplode(parts).alias("pos", "part"))


def concat_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's numbers and their products as one vector, one row per element."""
    from featurelane.functions.arrays import concat_vectors, elementwise_product
    users, _ = _profiles(Tables(spark, sf_dir))
    own, turned = F.array("user_clicks", "user_pplrty"), F.array("user_pplrty", "user_clicks")
    vector = concat_vectors([own, elementwise_product(own, turned)])
    return users.select("user_id", F.posexplode(vector).alias("pos", "x")).withColumn("x", _r(F.col("x")))


def shuffle_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: all orders in a seeded order, in 16 buffers, without a global sort."""
    from featurelane.operators.explore import buffered_shuffle
    return buffered_shuffle(Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], seed=42, buffers=16)


QUERIES = {
    "history_user_item": history_user_item,
    "history_user_token": history_user_token,
    "pos_neg_items": pos_neg_items,
    "item_popularity": item_popularity,
    "history_multi_unpivot": history_multi_unpivot,
    "activity_split": activity_split,
    "chrono_split": chrono_split,
    "latest_n": latest_n,
    "group_sizes": group_sizes,
    "freq_encode": freq_encode,
    "sorted_encode": sorted_encode,
    "array_encode": array_encode,
    "decode": decode,
    "standardize_pop": standardize_pop,
    "standardize_samp": standardize_samp,
    "multivalue_clean": multivalue_clean,
    "entity_unescape": entity_unescape,
    "longest_elements": longest_elements,
    "code_decode": code_decode,
    "bucket_labels": bucket_labels,
    "date_features": date_features,
    "range_median": range_median,
    "fill_median": fill_median,
    "fill_defaults": fill_defaults,
    "missing_fraction": missing_fraction,
    "unnest_stats": unnest_stats,
    "interval_flag": interval_flag,
    "fat_table": fat_table,
    "semi_topk": semi_topk,
    "semi_join_keys": semi_join_keys,
    "having_counts": having_counts,
    "topk_offset": topk_offset,
    "group_mean_rows": group_mean_rows,
    "pivot_mean_count": pivot_mean_count,
    "facet_pivot": facet_pivot,
    "describe_groups": describe_groups,
    "describe_global": describe_global,
    "box_stats": box_stats,
    "histogram": histogram,
    "corr_matrix": corr_matrix,
    "trend_line": trend_line,
    "pad_batches": pad_batches,
    "hash_cross": hash_cross,
    "pooling_weighted": pooling_weighted,
    "pooling_mean_sqrt": pooling_mean_sqrt,
    "vector_product": vector_product,
    "metrics_regression": metrics_regression,
    "roc_auc": roc_auc,
    "roc_curve": roc_curve,
    "series_compare": series_compare,
    "union_history": union_history,
    "csv_roundtrip": csv_roundtrip,
    "stream_score": stream_score,
    "stream_vocab": stream_vocab,
    "stream_json": stream_json,
    "ridge": ridge,
    "gbt_sales": gbt_sales,
    "wide_linear": wide_linear,
    "wide_deep": wide_deep,
    "score_batch": score_batch,
    "classifier": classifier,
    "als_hybrid": als_hybrid,
    "model_search": model_search,
    "vocab_sizes": vocab_sizes,
    "distinct_users": distinct_users,
    "tick_order": tick_order,
    "sample_rows": sample_rows,
    "shuffle_buffers": shuffle_buffers,
    "split_separator": split_separator,
    "concat_features": concat_features,
}

QUERIES |= flows.QUERIES
