"""Null group keys, damaged files and awkward CSV values."""

import os

import pytest

from featurelane.operators.explore import having_count, pivot_count, pivot_mean_count, value_counts
from featurelane.operators.history import entity_popularity, polarity_items
from featurelane.operators.split import group_sizes
from featurelane.session import checkpoint_dir
from featurelane.sources.io import load_stats, read_csv, save_stats, write_csv


@pytest.fixture()
def log(spark):
    return spark.createDataFrame([(1, 7, 1, 0), (1, 8, 0, 1), (None, 7, 1, 2), (2, 7, None, 3), (2, None, 0, 4)],
                                 "u long, i long, target int, ts long")


def test_null_keys_form_no_group(log):
    assert {r.u for r in value_counts(log, "u").collect()} == {1, 2}
    assert {r.u for r in having_count(log, ["u"], 1).collect()} == {1, 2}
    assert {(r.u, r.n) for r in group_sizes(log, "u").collect()} == {(1, 2), (2, 2)}
    assert {r.u for r in entity_popularity(log, "u", "target", "p").collect()} == {1, 2}
    cells = {r.u: (r["7"], r["8"]) for r in pivot_count(log, "u", "i").collect()}
    assert cells == {1: (1, 1), 2: (1, 0)}
    assert {r.u for r in pivot_mean_count(log, "u", "i", "target").collect()} == {1, 2}


def test_null_target_has_no_polarity(log):
    got = {(r.u, r.polarity, r.i) for r in polarity_items(log, "u", "i", "target", ["ts"]).collect()}
    assert got == {(1, "pos", 7), (1, "neg", 8), (2, "neg", None)}


def test_stats_missing_or_damaged(spark, tmp_path):
    assert load_stats(spark, str(tmp_path / "none")) is None
    save_stats(spark, {"mean": 1.5}, str(tmp_path / "s"))
    assert load_stats(spark, str(tmp_path / "s")) == {"mean": 1.5}
    for name in os.listdir(tmp_path / "s"):
        if name.startswith("part-"):
            (tmp_path / "s" / name).write_text("{broken")
        elif name.endswith(".crc"):
            (tmp_path / "s" / name).write_bytes(b"")
    with pytest.raises(Exception):
        load_stats(spark, str(tmp_path / "s"))


def test_csv_newlines_and_quotes(spark, tmp_path):
    rows = [(1, 'two\nlines, "quoted"'), (2, "plain"), (3, 'ends with \\')]
    df = spark.createDataFrame(rows, "k int, v string")
    write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "c"), {"k": "int", "v": "string"}, multi_line=True).collect())) == rows


def test_checkpoint_dir_is_set(spark):
    assert checkpoint_dir(spark)


def test_sample_does_not_depend_on_partitions(spark):
    from featurelane.operators.explore import random_sample, shuffle_rows
    df = spark.range(500).selectExpr("if(id % 50 = 0, null, id) as k", "id % 7 as v")
    few, many = df.repartition(3), df.repartition(9)
    a = [tuple(r) for r in random_sample(few, 60, 7).collect()]
    assert a == [tuple(r) for r in random_sample(many, 60, 7).collect()] and len(a) == 60
    assert a != [tuple(r) for r in random_sample(few, 60, 8).collect()]
    b = [tuple(r) for r in shuffle_rows(many, 7).collect()]
    assert b[:60] == a and len(b) == 500
    assert random_sample(df.limit(0), 5).count() == 0


def test_no_facet(spark):
    from featurelane.operators.explore import box_stats, histogram
    df = spark.range(1, 10).selectExpr("if(id = 9, null, cast(id as double)) as x", "1 as g")
    assert [tuple(r)[1:] for r in box_stats(df, ["g"], "x").collect()] == [tuple(r) for r in box_stats(df, [], "x").collect()]
    both = [sorted(map(tuple, histogram(df, f, "x", 4).collect())) for f in (["g"], [])]
    assert [r[1:] for r in both[0]] == both[1] and sum(r[1] for r in both[1]) == 8
    assert histogram(df.where("x > 99"), [], "x").count() == 0
    assert [r.q1 for r in box_stats(df.where("x > 99"), [], "x").collect()] == [None]


def test_pooling_keeps_rows_of_unknown_items(spark):
    from featurelane.operators.pooling import mean_sqrt_pool, vectors_long, weighted_pool
    emb = vectors_long(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, v array<double>"), "id", "v")
    items = spark.createDataFrame([("a", 1, 3.0), ("a", 9, 4.0), ("b", 9, 1.0), ("c", None, 1.0)], "u string, i long, w double")
    pooled = {(r.u, r.dim): round(r.x, 6) for r in weighted_pool(items, ["u"], "i", "w", emb).collect()}
    assert pooled == {("a", 0): 0.6, ("a", 1): 1.2, ("b", 0): 0.0, ("b", 1): 0.0, ("c", 0): 0.0, ("c", 1): 0.0}
    mean = {(r.u, r.dim): round(r.x, 6) for r in mean_sqrt_pool(items, ["u"], "i", emb).collect()}
    assert mean[("a", 1)] == round(2 / 2 ** 0.5, 6) and mean[("b", 0)] == 0.0 and len(mean) == 6
    assert weighted_pool(items, ["u"], "i", "w", emb.limit(0)).count() == 0
