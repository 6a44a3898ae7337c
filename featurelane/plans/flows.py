"""Registered queries of the end-to-end flows: interaction log (A) and daily sales (B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.functions.arrays import array_len
from featurelane.functions.codes import age_buckets, bucket_labels, code_norm, code_parts, two_digit_year
from featurelane.functions.dates import days_between, yyyymmdd_to_days
from featurelane.functions.text import multivalue_clean
from featurelane.operators.clean import drop_columns, fill_median, range_median
from featurelane.plans import interaction as A
from featurelane.plans import sales as B
from featurelane.plans.common import _r, lineitem_log
from featurelane.session import cut_lineage
from featurelane.sources.tables import Tables
from featurelane.streaming.serve import VersionedServing, read_stream, work_dir

# ----------------------------------------------------------------- interaction log (A)

ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]  # total


def interaction_spec() -> A.InteractionSpec:
    return A.InteractionSpec(
        user="o_custkey", item="l_partkey", target="target", order=ORDER, context=["l_linestatus", "o_orderstatus", "o_orderpriority"],
        user_catg=["city", "c_mktsegment", "age_catg"], user_numeric=["age_num", "registered", "expires", "tenure"],
        item_catg=["p_brand", "language", "cc", "xxx"], item_multi=["genres"], item_numeric=["p_retailprice", "yy"], item_plain=["n_genres"],
        user_hist={"l_linestatus": A.COUNT, "o_orderstatus": A.COUNT, "o_orderpriority": A.COUNT, "p_brand": A.BOTH, "language": A.BOTH, "genres": A.BOTH},
        item_hist={"l_linestatus": A.COUNT, "o_orderstatus": A.COUNT, "o_orderpriority": A.COUNT, "city": A.COUNT, "c_mktsegment": A.BOTH, "age_catg": A.BOTH})


def interaction_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lineitem log, and both profiles as raw text: dates as yyyymmdd, codes, pipe-separated values, an age out of range here and there."""
    spec = interaction_spec()
    day = F.date_add(F.lit("1992-01-01").cast("date"), F.pmod("c_custkey", F.lit(1000)).cast("int"))
    users = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("city"), "c_mktsegment",
                              F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"), F.date_format(day, "yyyyMMdd").alias("registered"),
                              F.date_format(F.date_add(day, F.pmod(F.col("c_custkey") * 7, F.lit(900)).cast("int")), "yyyyMMdd").alias("expires"))
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("language"),
                          F.concat(F.lit(" "), F.col("p_type"), F.lit(" | "), F.translate("p_name", " ", "|"), F.lit("|")).alias("genres"),
                          F.concat(F.lit("US"), F.substring("p_type", 1, 3), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("code"), "p_retailprice")
    return lineitem_log(t).select("o_custkey", "target", *spec.order, *spec.context), users, items


def interaction_features(users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both raw profiles with their own features."""
    bins, labels = age_buckets()
    users = range_median(users.withColumns({"city": code_norm("city"), "age_catg": bucket_labels("age", bins, labels)}), "age", 6, 80, "age_num")
    users = users.withColumns({"registered": yyyymmdd_to_days("registered"), "expires": yyyymmdd_to_days("expires")})
    users = users.withColumns({"tenure": days_between("expires", "registered"), "age_num": F.col("age_num").cast("double")})
    items = items.select("*", *code_parts("code", {"cc": (1, 2), "xxx": (3, 3), "_yy": (6, 2)}))
    items = fill_median(items.withColumns({"language": code_norm("language"), "genres": multivalue_clean("genres"), "yy": two_digit_year("_yy").cast("double")}), ["yy"])
    items = items.withColumns({"yy": F.col("yy") - 1900, "n_genres": array_len("genres")})
    return drop_columns(users, ["age"]), drop_columns(items, ["code", "_yy"])


def _interaction(spark: SparkSession, sf_dir: str) -> tuple[A.InteractionModel, DataFrame, DataFrame]:
    """The model, saved and loaded again, and both parts of the log."""
    spec = interaction_spec()
    log, users, items = interaction_inputs(Tables(spark, sf_dir))
    users, items = interaction_features(users, items)
    train, valid = A.split(A.clean(log, spec), spec)
    base = work_dir(spark, "interaction")
    A.fit(A.prepare(train, users, items, spec), spec).save(spark, base)
    return A.InteractionModel.load(spark, base), train, valid


def _listed(ids: Column) -> Column:
    """Numbers (no nulls) with commas between; as JSON without its brackets, which makes no array of texts first."""
    text = F.to_json(ids)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def interaction_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline A on the lineitem log: both parts encoded by the saved and reloaded state, arrays as text.

    Exercises N1-N5, W1, A1-A5, F1-F8, F13, R1-R3, R6, E2, E3, E6, E8, E9, E16, J1, J3, P2-P4.
    """
    model, train, valid = _interaction(spark, sf_dir)
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    shown = {"ids": _listed, "number": _r, "weights": F.size}
    return model.transform(both, lambda f, c: shown[f.kind](c) if f.kind in shown else c).drop("l_shipdate")


def interaction_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline A's encoded profiles, every array element with its weights: (owner, key, feature, pos, id, cnt, mean)."""
    model, _train, _valid = _interaction(spark, sf_dir)
    parts = []

    def elements(owner: str, c: str, mean: bool) -> Column:
        weights = F.col(f"{owner}_{c}_mean") if mean else F.array().cast("array<double>")
        zipped = F.arrays_zip(F.col(f"{owner}_{c}_hist").alias("id"), F.col(f"{owner}_{c}_count").alias("cnt"), weights.alias("mean"))
        return F.transform(zipped, lambda x, k: F.struct(F.lit(c).alias("feature"), (k + 1).alias("pos"), x["id"].alias("id"),
                                                         x["cnt"].alias("cnt"), x["mean"].alias("mean")))

    queries = {"pos_query": A.COUNT, "neg_query": A.COUNT}
    for owner, frame, key, of in (("user", model.users, "raw_o_custkey", model.spec.user_hist | queries), ("item", model.items, "raw_l_partkey", model.spec.item_hist)):
        rows = F.flatten(F.array(*[elements(owner, c, "mean" in s) for c, s in of.items()]))
        parts.append(frame.select(F.lit(owner).alias("owner"), F.col(key).alias("key"), F.explode(rows).alias("x")).select("owner", "key", "x.*"))
    return parts[0].unionByName(parts[1]).withColumn("mean", _r(F.col("mean")))


def score_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of both parts scored by the saved classifier, in padded batches of at most 1,000 rows."""
    model, train, valid = _interaction(spark, sf_dir)
    base = work_dir(spark, "classifier")
    A.fit_classifier(model, train).save(spark, base)
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    scored = A.InteractionModel.load(spark, base).predict_padded(both, keep=["l_orderkey", "l_linenumber", "split", "target"])
    return scored.select("l_orderkey", "l_linenumber", "split", "target", _r(F.col("prob")).alias("prob"))


# --------------------------------------------------------------------- daily sales (B)

def sales_inputs(t: Tables):
    """Daily supplier sales as a store log, suppliers as stores, nations as states."""
    li = t.lineitem.select("l_suppkey", "l_orderkey", "l_discount",
                           (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"),
                           F.to_date("l_shipdate").alias("d"))
    daily = cut_lineage(li.groupBy("l_suppkey", "d").agg(F.sum("rev").alias("rev"), F.count_distinct("l_orderkey").alias("n"),
                                                         F.avg("l_discount").alias("disc")))  # stage end: the flows read the log several times
    closed = F.dayofweek("d") == 1
    log = daily.select(F.col("l_suppkey").cast("int").alias("Store"), F.dayofweek("d").cast("string").alias("DayOfWeek"),
                       F.date_format("d", "yyyy-MM-dd").alias("Date"),
                       F.when(closed, 0.0).otherwise(F.col("rev")).alias("Sales"),
                       F.when(closed, 0.0).otherwise(F.col("n").cast("double")).alias("Customers"),
                       F.when(closed, "0").otherwise("1").alias("Open"),
                       F.when(F.round("disc", 6) > 0.05, "1").otherwise("0").alias("Promo"),
                       F.lit("0").alias("StateHoliday"), F.lit("0").alias("SchoolHoliday"))
    intervals = F.array(F.lit("Jan,Apr,Jul,Oct"), F.lit("Feb,May,Aug,Nov"), F.lit("Mar,Jun,Sept,Dec"))
    su = t.supplier
    store = su.select(F.col("s_suppkey").cast("int").alias("Store"),
                      F.element_at(F.array(*[F.lit(x) for x in "abcd"]), F.pmod("s_nationkey", F.lit(4)) + 1).alias("StoreType"),
                      F.element_at(F.array(*[F.lit(x) for x in "abc"]), F.pmod("s_suppkey", F.lit(3)).cast("int") + 1).alias("Assortment"),
                      F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("CompetitionDistance"),
                      F.when(F.col("s_acctbal") >= 0, (F.pmod("s_suppkey", F.lit(12)) + 1).cast("string")).alias("CompetitionOpenSinceMonth"),
                      F.when(F.col("s_acctbal") >= 0, (F.pmod("s_nationkey", F.lit(10)) + 2000).cast("string")).alias("CompetitionOpenSinceYear"),
                      F.when(F.pmod("s_nationkey", F.lit(2)) == 0, "1").otherwise("0").alias("Promo2"),
                      (F.pmod("s_suppkey", F.lit(52)) + 1).cast("string").alias("Promo2SinceWeek"),
                      F.lit("2005").alias("Promo2SinceYear"),
                      F.element_at(intervals, F.pmod("s_nationkey", F.lit(3)) + 1).alias("PromoInterval"))
    states = su.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").select(
        F.col("s_suppkey").cast("int").alias("Store"), F.col("n_name").alias("State"))
    return log, store, states


def _floats(df: DataFrame) -> DataFrame:
    """Every double column rounded for comparison."""
    return df.select(*[_r(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def sales_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline B up to the model: both parts in the declared header, scaled by the training part's
    statistics, with the log target.

    P1, P3, P5, P6, P9, N1, N2, N5, F9-F12, J1, J9, J10, R4, R5, A7, A8, W2, E7.
    """
    _state, train, valid = B.train(*sales_inputs(Tables(spark, sf_dir)), B.SalesSpec())
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    return _floats(both)


def sales_crosses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four feature crosses of 2 to 6 columns, hashed into 10,000 buckets, of both parts."""
    _state, train, valid = B.train(*sales_inputs(Tables(spark, sf_dir)), B.SalesSpec())
    return B.crosses(train.unionByName(valid)).select("store", "date", *B.CROSSES)


def sales_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline B to the end: the state is trained, saved as a bundle and loaded again (E9, S7), the split dates are
    written and read (S6), and the loaded state predicts every day after the training part, closed days too (M1, M13)."""
    from featurelane.sources import io
    t = Tables(spark, sf_dir)
    log, store, states = sales_inputs(t)
    dates, base = work_dir(spark, "dates"), work_dir(spark, "sales")
    state, _train, _valid = B.train(log, store, states, B.SalesSpec(), dates_path=dates)
    state.save(spark, base)
    loaded = B.SalesState.load(spark, base)
    seen = io.read_series(spark, dates, {"store": "int", "date": "string", "split": "string"}).where(F.col("split") == "train")
    new = log.withColumnsRenamed({"Store": "store", "Date": "date"}).join(seen, ["store", "date"], "left_anti")
    actual = new.select("store", "date", F.col("Sales").alias("actual"))
    return loaded.predict(new).join(actual, ["store", "date"]).select("store", "date", "open", F.round("actual", 2).alias("actual"), "pred")


def sales_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New daily records with the state of a saved bundle (no refit, no filter), unscaled."""
    log, store, states = sales_inputs(Tables(spark, sf_dir))
    base = work_dir(spark, "sales")
    B.train(log, store, states, B.SalesSpec(), ["sales_mean"], [])[0].save(spark, base)
    state = B.SalesState.load(spark, base)
    state.stats = {}
    return _floats(state.features(log.drop("Sales", "Customers")).drop("customers"))


def sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New daily records, as a stream of files, served by the saved bundle (a ridge on the store mean)."""
    log, store, states = sales_inputs(Tables(spark, sf_dir))
    base, inbox = work_dir(spark, "sales"), work_dir(spark, "inbox")
    B.train(log, store, states, B.SalesSpec(), ["sales_mean"], [])[0].save(spark, f"{base}/bundle")
    new = log.drop("Sales", "Customers")
    new.write.parquet(inbox)
    serving = VersionedServing(spark, f"{base}/bundle", B.SalesState.load, f"{base}/served")
    serving.run(read_stream(spark, inbox, new.schema), f"{base}/checkpoint")
    out = serving.results().select("store", "date", "open", "day_of_week", "promo2", _r(F.col("sales_mean")).alias("sales_mean"), "pred")
    return out.withColumn("pred", F.col("pred") + 0.0)


QUERIES = {f.__name__: f for f in (interaction_flow, interaction_profiles, score_padded, sales_prepared, sales_crosses, sales_flow, sales_serving, sales_stream)}
