"""Searches, factors and shuffles: fixed splits, no leaks, results that do not depend on partitions."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from featurelane.operators.explore import buffered_shuffle
from featurelane.operators.metrics import auc, auc_by, regression_metrics, rmspe
from featurelane.plans import models as M
from featurelane.plans.factors import out_of_fold_factors
from featurelane.plans.search import TRIALS, Search, search


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        a, k = rnd.gauss(0, 1), rnd.choice("abc")
        y = 3 + 0.5 * a + {"a": 0.0, "b": 0.4, "c": -0.3}[k] + rnd.gauss(0, 0.1)
        rows.append((i, a, ord(k) - 97, y, int(y + rnd.gauss(0, 0.2) > 3)))
    return spark.createDataFrame(rows, "id int, a double, k int, y double, t int")


@pytest.mark.parametrize("metric", ["rmspe", "auc"])
def test_search_keeps_the_best_and_survives_saving(spark, table, tmp_path, metric):
    train, valid = table.where("id % 4 != 0"), table.where("id % 4 = 0")
    label = "y" if metric == "rmspe" else "t"
    estimator = LinearRegression(labelCol="y") if metric == "rmspe" else LogisticRegression(labelCol="t", maxIter=10)
    prepared = Pipeline(stages=M.vectors(["a"], ["k"])).fit(train)
    found = search(train, valid, label, prepared, estimator, {"regParam": ("log", 1e-4, 100.0), "elasticNetParam": ("discrete", [0.0, 0.5])}, metric, trials=6)
    assert len(found.trials) == 6 and {t["params"]["elasticNetParam"] for t in found.trials} <= {0.0, 0.5}
    values = [t["value"] for t in found.trials]
    assert found.best["value"] == (min if metric == "rmspe" else max)(values) and len(set(values)) > 1
    found.save(spark, str(tmp_path / "s"))
    loaded = Search.load(spark, str(tmp_path / "s"))
    assert (loaded.trials, loaded.best, loaded.metric) == (found.trials, found.best, metric)
    pred = loaded.model.transform(valid)
    again = regression_metrics(pred, "y", "prediction", log_target=True).first()["rmspe"] if metric == "rmspe" else \
        auc(M.probability(pred), "t", "prob").first()["auc"]
    assert again == pytest.approx(found.best["value"])


def test_default_trials_and_one_class(spark, table):
    assert TRIALS == {"rmspe": 30, "auc": 10}
    prepared = Pipeline(stages=M.vectors(["a"])).fit(table)
    with pytest.raises(ValueError):
        search(table, table.where("t = 1"), "t", prepared, LogisticRegression(labelCol="t", maxIter=2), {"regParam": ("linear", 0.0, 1.0)}, "auc", 2)


def test_auc_by_group_equals_auc(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.randint(0, 1), float(rnd.randint(0, 9))) for g in "xy" for _ in range(120)] + [("one", 1, 1.0), ("one", 1, 2.0)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in auc_by(df, "g", "y", "s").collect()}
    for g in "xy":
        assert got[g] == pytest.approx(auc(df.where(F.col("g") == g), "y", "s").first()["auc"])
    assert got["one"] is None
    reg = spark.createDataFrame([(1.0, 0.9), (2.0, 2.5), (0.0, 1.0)], "y double, p double")
    for log in (False, True):
        assert reg.agg(rmspe("y", "p", log)).first()[0] == pytest.approx(regression_metrics(reg, "y", "p", log).first()["rmspe"])


def test_ids_are_indicators(table):
    """Numbering the categories otherwise changes nothing."""
    a = M.probability(M.classifier(table, "t", ["a"], ids=["k"]).transform(table))
    other = table.withColumn("k", F.element_at(F.array(F.lit(2), F.lit(0), F.lit(1)), F.col("k") + 1))
    b = M.probability(M.classifier(other, "t", ["a"], ids=["k"]).transform(other))
    x, y = ({r["id"]: r["prob"] for r in d.collect()} for d in (a, b))
    assert all(abs(x[i] - y[i]) < 1e-5 for i in x)


def test_factors_take_any_keys_and_leak_nothing(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["u1", "u2", "u3", "ü"]), 2**40 + rnd.randint(0, 5), rnd.randint(0, 1)) for i in range(120)]
    rows += [(200, "u1", None, 1), (201, None, 2**40, 0), (202, "only once", 2**40, 1)]
    train = spark.createDataFrame(rows, "id int, u string, i long, t int")
    valid = spark.createDataFrame([(900, "u1", 2**40, 1), (901, "new", 7, 0), (902, None, None, 1)], "id int, u string, i long, t int")
    a, b = out_of_fold_factors(train, valid, "u", "i", "t", ["id"], rank=3)
    assert a.count() == len(rows) and b.count() == 3 and a.columns == b.columns
    new = b.where("id = 901").first()
    assert new["mf_0"] == new["mf_1"] == new["mf_2"] == 0.0
    assert new["user_mean"] == pytest.approx(train.agg(F.avg("t")).first()[0])
    # a row's own target is not in its features: flipping it changes those of other rows only
    flipped = train.withColumn("t", F.when(F.col("id") == 5, 1 - F.col("t")).otherwise(F.col("t")))
    c, _ = out_of_fold_factors(flipped, valid, "u", "i", "t", ["id"], rank=3)
    names = ["user_mean", "mf_0", "mf_1", "mf_2"]
    x, y = ([d.where("id = 5").first()[n] for n in names] for d in (a, c))
    assert x == pytest.approx(y)


def test_buffered_shuffle_is_the_same_for_any_partitions(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as k")
    got = [{(r["id"], r["buffer"], r["pos"]) for r in buffered_shuffle(df.repartition(n), ["id"], 7, 8).collect()} for n in (3, 9)]
    assert got[0] == got[1] and len(got[0]) == 1000
    sizes = [sum(1 for x in got[0] if x[1] == b) for b in range(8)]
    assert min(sizes) > 80 and {p for _, b, p in got[0] if b == 0} == set(range(1, sizes[0] + 1))
    assert got[0] != {(r["id"], r["buffer"], r["pos"]) for r in buffered_shuffle(df, ["id"], 8, 8).collect()}
    assert buffered_shuffle(df.where("false"), ["id"]).count() == 0
