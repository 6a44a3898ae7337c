"""Brute-force checks on small fixtures: splits, AUC, ridge closed form,
stream = batch, sources round trips."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF


def _pandas_activity_split(ev: pd.DataFrame, valid: float) -> dict:
    """Plain pandas loop written from the split description."""
    sizes = ev.groupby("user_id").size()
    lo, hi = int(sizes.quantile(0.25)), int(sizes.quantile(0.75))
    out = {}
    for _, g in ev.sort_values(["ts", "event_id"]).groupby("user_id"):
        if len(g) < lo:
            continue
        g = g.iloc[-hi:]
        n_train = int(len(g) * (1 - valid))
        for i, eid in enumerate(g.event_id):
            out[eid] = "train" if i < n_train else "valid"
    return out


def test_activity_split_brute_force(spark):
    import __spark_entry__ as E
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "ts").toPandas()
    want = _pandas_activity_split(ev, 0.1)
    got = {r["event_id"]: r["split"] for r in E.queries()["activity_split"](spark, SF).collect()}
    assert got == want


def test_chrono_split_brute_force(spark):
    import __spark_entry__ as E
    od = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate").toPandas()
    want = {}
    for _, g in od.sort_values(["o_orderdate", "o_orderkey"]).groupby("o_custkey"):
        cut = len(g) - int(len(g) * 0.3)
        for i, k in enumerate(g.o_orderkey):
            want[k] = "train" if i < cut else "valid"
    got = {r["o_orderkey"]: r["split"] for r in E.queries()["chrono_split"](spark, SF).collect()}
    assert got == want


def test_auc_matches_pairwise(spark):
    from featurelane.operators.metrics import auc, roc_points
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert math.isclose(auc(df, "y", "s").first()["auc"], pairs / (len(pos) * len(neg)), rel_tol=1e-12)
    pts = roc_points(df, "y", "s").orderBy(F.col("score").desc()).collect()
    assert math.isclose(pts[-1]["tpr"], 1.0) and math.isclose(pts[-1]["fpr"], 1.0)


def test_ridge_closed_form(spark):
    from featurelane.plans.models import ridge
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.1, size=200)
    alpha = 0.5
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y, "k": "z"}))
    model = ridge(df, "y", ["a", "b", "c"], ["k"], alpha=alpha)
    coef = model.stages[-1].coefficients.toArray()[:3]
    assert np.allclose(coef, w, atol=1e-6)


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    got = E.queries()["stream_score"](spark, SF)
    log = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").alias("item"),
        (F.col("event_type") == "purchase").cast("int").alias("t"))
    u = log.groupBy("user_id").agg(F.avg("t").alias("up"), F.count("t").cast("double").alias("user_clicks"))
    i = log.groupBy("item").agg(F.avg("t").alias("ip"), F.count("t").cast("double").alias("item_clicks"))
    want = (log.join(u, "user_id", "left").join(i, "item", "left")
               .select("event_id", "user_id", "item", "user_clicks", "item_clicks",
                       F.round((F.col("up") + F.col("ip")) / 2, 6).alias("score")))
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_sources_roundtrip(spark, tmp_path):
    from featurelane.sources import io
    df = spark.createDataFrame([(1, None, 2.0), (2, "b", None)], "k int, s string, x double")
    io.write_csv(df, str(tmp_path / "csv"))
    back = io.read_csv(spark, str(tmp_path / "csv"), {"k": "int", "s": "string", "x": "double"},
                       defaults={"s": "", "x": 0.0})
    assert sorted(tuple(r) for r in back.collect()) == [(1, "", 2.0), (2, "b", 0.0)]
    assert io.load_stats(spark, str(tmp_path / "missing")) is None
    io.save_stats(spark, {"x": {"mean": 1.0}}, str(tmp_path / "stats"))
    assert io.load_stats(spark, str(tmp_path / "stats")) == {"x": {"mean": 1.0}}
    assert io.preview(spark, str(tmp_path / "csv"), 1).count() == 1
    from featurelane.operators.clean import camel_to_snake
    assert [camel_to_snake(c) for c in ["Promo2SinceWeek", "DayOfWeek", "CompetitionOpenSinceMonth", "Promo2"]] == \
        ["promo2since_week", "day_of_week", "competition_open_since_month", "promo2"]


def test_partial_fit_accumulates(spark):
    from featurelane.operators import encoders as E
    a = E.label_counts(spark.createDataFrame([("x",), ("y",)], "v string"), "v")
    b = E.label_counts(spark.createDataFrame([("y",), ("y",), ("z",)], "v string"), "v")
    vocab = {r["label"]: r["idx"] for r in E.rank_counts(E.merge_counts(a, b)).collect()}
    assert vocab == {"y": 1, "x": 2, "z": 3}
    assert {r["label"] for r in E.rank_counts(E.merge_counts(a, b), min_freq=2).collect()} == {"y"}


def test_vocabulary_sizes_read_the_log_once(spark):
    """one read for all columns, with nulls, outliers and empty arrays left out."""
    from featurelane.operators.explore import vocabulary_sizes
    df = spark.createDataFrame([("a", ["x", "y"]), ("", None), (None, []), ("b", ["x", None, ""])], "c string, m array<string>")
    got = vocabulary_sizes(df, ["c"], ["m"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert {r["feature"]: r["n_unique"] for r in got.collect()} == {"c": 2, "m": 2}


def test_daily_log_is_staged_and_labels_are_counted_once(spark):
    """The daily log is aggregated once; one pass counts the labels of all columns."""
    from featurelane.plans import flows, models as M
    from featurelane.sources.tables import Tables
    log, _store, _states = flows.sales_inputs(Tables(spark, SF))
    assert "Aggregate" not in log._jdf.queryExecution().optimizedPlan().toString() and log.count() > 0
    df = spark.createDataFrame([(1.0, 2.0, "a", "p"), (2.0, 3.0, "b", "q"), (3.0, 5.0, "a", "q"), (4.0, 1.0, "b", "p")], "y double, x double, c string, d string")
    model = M.ridge(df, "y", ["x"], ["c", "d"])
    assert sum(type(s).__name__ == "StringIndexerModel" for s in model.stages) == 1
