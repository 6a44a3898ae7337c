"""The skew-safe primitives equal plain windows, including on a hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from featurelane.operators.ordered import exact_quantiles, number_within, running_sums


def _skewed(spark):
    # key 0 holds about a third of the rows
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
                                    ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))


def test_number_within_equals_row_number(spark):
    df = _skewed(spark)
    got = number_within(df, ["k"], ["v", "id"], "pos", num_partitions=7)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
    assert got.select("id", "pos").exceptAll(want.select("id", F.col("pos").cast("long"))).count() == 0
    assert got.count() == df.count()


def test_global_numbering_desc(spark):
    df = spark.range(100)
    got = number_within(df, [], [F.col("id").desc()], "rn", num_partitions=5)
    assert all(r["rn"] == 100 - r["id"] for r in got.collect())


def test_running_sums(spark):
    df = _skewed(spark)
    got = running_sums(df, ["k"], ["v", "id"], {"cs": F.col("v")}, num_partitions=6)
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cs", F.sum("v").over(w))
    assert got.select("id", "cs").exceptAll(want.select("id", "cs")).count() == 0


def test_exact_quantiles_match_percentile(spark):
    df = _skewed(spark).withColumn("x", F.col("v") / 3.0)
    got = {r["k"]: (r["a"], r["b"]) for r in exact_quantiles(df, ["k"], "x", [0.25, 0.75], ["a", "b"]).collect()}
    want = df.groupBy("k").agg(F.percentile("x", 0.25).alias("a"), F.percentile("x", 0.75).alias("b"))
    for r in want.collect():
        assert abs(got[r["k"]][0] - r["a"]) < 1e-9 and abs(got[r["k"]][1] - r["b"]) < 1e-9


def test_global_quantile_empty(spark):
    df = spark.createDataFrame([], "x double")
    r = exact_quantiles(df, [], "x", [0.5], ["m"]).collect()
    assert len(r) == 1 and r[0]["m"] is None


def test_no_task_holds_everything(spark):
    """Neither a numbering, a running sum nor a quantile plans a single partition over the rows."""
    df = _skewed(spark)
    for out in (number_within(df, [], ["v", "id"], "pos", num_partitions=6), running_sums(df, ["k"], ["v", "id"], {"s": F.col("v")}, num_partitions=6)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan or "Join" in plan
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(per_task) < 3000


def test_hot_key_is_cut_into_slices(spark):
    """The sliced path spreads one key that holds a third of the rows over many tasks."""
    from featurelane.operators.ordered import _sliced
    df = _skewed(spark)
    t = _sliced(df, ["k"], [F.col("v"), F.col("id")], 8)
    per_slice = {r["_blk"]: r["n"] for r in t.where("k = 0").groupBy("_blk").agg(F.count("*").alias("n")).collect()}
    assert len(per_slice) >= 3                       # the hot key spans several slices
    assert max(per_slice.values()) < 1040 * 0.75     # no slice holds most of it


def test_split_is_a_partition(spark):
    from featurelane.operators.split import activity_split, chrono_split
    df = _skewed(spark)
    c = chrono_split(df, "k", ["v", "id"], valid=0.3)
    assert c.count() == df.count() and c.select("id").distinct().count() == df.count()
    a = activity_split(df, "k", ["v", "id"], valid=0.1)
    assert a.select("id").distinct().count() == a.count()
    assert set(r[0] for r in a.select("split").distinct().collect()) <= {"train", "valid"}


def test_split_leaves_rows_out_before_they_move(spark):
    """A user's older rows go before the shuffle, and the rows kept are those of numbering the whole log."""
    from featurelane.operators.split import activity_split
    df, limit = _skewed(spark), "spark.sql.optimizer.windowGroupLimitThreshold"
    limited = activity_split(df, "k", ["v", "id"], valid=0.1)
    assert "WindowGroupLimit" in limited._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, limited.collect()))
    given = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "0")
        assert sorted(map(tuple, activity_split(df, "k", ["v", "id"], valid=0.1).collect())) == got and len(got) > 100
    finally:
        spark.conf.set(limit, given)


def test_unnest_count_is_sum_of_sizes(spark):
    from featurelane.operators.history import unnest
    df = spark.range(200).select("id", F.sequence(F.lit(0), F.col("id") % 5).alias("a"))
    df = df.withColumn("a", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("a").cast("array<string>")))
    want = df.select(F.sum(F.coalesce(F.size("a"), F.lit(1)))).first()[0]
    assert unnest(df, "a", ["id"], pos="p").count() == want


def test_padded_lengths_equal_per_batch(spark):
    from featurelane.operators.multivalue import batches, pad_in_batch
    df = spark.range(50).select("id", F.sequence(F.lit(0), F.col("id") % 9).alias("a"))
    out = pad_in_batch(batches(df, ["id"], 8), "a")
    lens = out.groupBy("batch_id").agg(F.countDistinct(F.size("a")).alias("n")).collect()
    assert all(r["n"] == 1 for r in lens) and len(lens) == 7


def test_approx_quantiles_close_to_exact(spark):
    from featurelane.operators.ordered import approx_quantiles
    df = _skewed(spark).withColumn("x", F.col("v") / 3.0)
    ex = {r["k"]: r["m"] for r in exact_quantiles(df, ["k"], "x", [0.5], ["m"]).collect()}
    ap = {r["k"]: r["m"] for r in approx_quantiles(df, ["k"], "x", [0.5], ["m"]).collect()}
    assert ex.keys() == ap.keys()
    assert abs(ex[0] - ap[0]) <= 2.0   # the 1,040-row group: values span 0..333, dense
