"""Pipeline A: typed columns, one-pass histories and vocabularies, saved state, padded scoring."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from featurelane.operators import encoders as E
from featurelane.operators import history as H
from featurelane.operators.padded import check_batch, padded, slices
from featurelane.plans import flows
from featurelane.plans import interaction as A
from featurelane.sources.bundle import DamagedBundle
from featurelane.sources.tables import Tables

LOG = [("u1", "i1", "x", ["a", "b"], 1), ("u1", "i2", "", ["b"], 0), ("u1", "i1", None, None, 1), ("u2", "i3", "x", [], None), (None, "i1", "y", ["a"], 1),
       ("u2", "i2", "y", ["a", "a", None], 0)]
LOG_SCHEMA = "u string, i string, c string, m array<string>, t int"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def fitted(spark):
    spec = flows.interaction_spec()
    log, users, items = flows.interaction_inputs(Tables(spark, SF))
    users, items = flows.interaction_features(users, items)
    train, valid = A.split(A.clean(log, spec), spec)
    model = A.fit_classifier(A.fit(A.prepare(train, users, items, spec), spec), train)
    return model, train, valid


def spec_with(**more):
    given = dict(user="u", item="i", target="t", order=["o"], context=["p_type"], user_catg=["type"], user_numeric=[], item_catg=["my_mean"],
                 item_multi=["a_count"], item_numeric=["n_count"])
    return A.InteractionSpec(**(given | more))


def test_columns_are_declared_not_guessed():
    """Names that end alike, or like a statistic, keep their own vocabulary and kind."""
    got = {f.name: f for f in A.features(spec_with(user_hist={"p_type": A.COUNT, "my_mean": A.BOTH, "a_count": A.BOTH}))}
    assert got["user_p_type_hist"].vocab == "p_type" and got["item_type_hist"].vocab == "type"
    assert got["my_mean"].kind == "id" and got["n_count"].kind == "number" and got["a_count"].kind == "ids"
    assert got["user_my_mean_mean"].kind == "weights" and got["user_a_count_hist"].vocab == "a_count"
    with pytest.raises(ValueError):
        A.features(spec_with(item_numeric=["my_mean"]))


@pytest.mark.parametrize("entity", ["u", "i"])
def test_history_matrix_brute_force(spark, entity):
    log = spark.createDataFrame(LOG, LOG_SCHEMA)
    stats = {"c": ["count"], "m": ["count", "mean"]}
    got = {r[entity]: r for r in H.history_matrix(log, entity, stats, "t", "h", ["m"]).collect()}
    want = defaultdict(lambda: {"c": defaultdict(list), "m": defaultdict(list)})
    for u, i, c, m, t in LOG:
        key = u if entity == "u" else i
        if key is None:
            continue
        if c is not None:
            want[key]["c"][c].append(t)
        for v in [""] if m is None else m:
            if v is not None:
                want[key]["m"][v].append(t)
    for key, per in want.items():
        for f in ("c", "m"):
            values = sorted(per[f])
            kept = [[t for t in per[f][v] if t is not None] for v in values]
            assert got[key][f"h_{f}_hist"] == values and got[key][f"h_{f}_count"] == [len(k) for k in kept]
            if f == "m":
                assert got[key]["h_m_mean"] == [sum(k) / len(k) if k else None for k in kept]
    assert set(got) == set(want)


@pytest.mark.parametrize("together", [1, 1 << 15])
@pytest.mark.parametrize("entity", ["u", "i"])
def test_bounded_histories_are_the_same(spark, entity, together):
    """Rows that are gathered by entity, a few or many entities at once, give the histories of rows that are unpivoted."""
    import random
    r = random.Random(3)
    log = LOG + [(r.choice(["u1", "u7", "u8", None, "é"]), r.choice(["i1", "i9", None]), r.choice(["x", "", None, "ü"]),
                  r.choice([None, [], ["b", None, "a"], ["a", "a"]]), r.choice([0, 1, None])) for _ in range(300)] + [("only", "only", None, [], 1)]
    table = spark.createDataFrame(log, LOG_SCHEMA)
    stats = {"c": ["count"], "m": ["count", "mean"]}
    want = sorted(map(str, H.history_matrix(table, entity, stats, "t", "h", ["m"]).collect()))
    assert sorted(map(str, H._bounded_matrix(table, entity, stats, "t", "h", ["m"], together).collect())) == want
    assert H.history_matrix(table, entity, stats, "t", "h", ["m"], bounded=True).schema.names == H.history_matrix(table, entity, stats, "t", "h", ["m"]).schema.names
    assert H._bounded_matrix(table.limit(0), entity, stats, "t", "h", ["m"], together).count() == 0


def test_vocabulary_of_columns_together(spark):
    """Counting combinations of columns first changes no frequency and no number."""
    log = spark.createDataFrame(LOG * 3 + LOG[:2], LOG_SCHEMA)
    want = sorted(map(str, E.vocabulary_table(log, ["u", "i", "c"], ["m"]).collect()))
    for together in ([["u", "c"], ["i", "m"]], [["i", "m"]], [["u", "i", "c", "m"]]):
        assert sorted(map(str, E.vocabulary_table(log, ["u", "i", "c"], ["m"], together=together).collect())) == want and len(want) > 5


def test_polarity_arrays(spark):
    log = spark.createDataFrame([("u", "b", 1, 2), ("u", "a", 1, 1), ("u", "c", 0, 3), ("v", "d", None, 4), (None, "e", 1, 5)], "u string, i string, t int, o int")
    got = {r["u"]: r for r in H.polarity_arrays(log, "u", "i", "t", ["o"], "x").collect()}
    assert got["u"]["x_pos_query_hist"] == ["a", "b"] and got["u"]["x_pos_query_count"] == [1.0, 1.0] and got["u"]["x_neg_query_hist"] == ["c"]
    assert got["v"]["x_pos_query_hist"] == [] and set(got) == {"u", "v"}


def test_vocabulary_table_and_codes(spark):
    log = spark.createDataFrame(LOG, LOG_SCHEMA)
    table = E.vocabulary_table(log, ["u", "c"], ["m"])
    got = {(r["column"], r["label"]): (r["freq"], r["idx"]) for r in table.collect()}
    want = {}
    for col, labels in (("u", [r[0] for r in LOG]), ("c", [r[2] for r in LOG]), ("m", [v for r in LOG for v in r[3] or []])):
        n = Counter(x for x in labels if x)
        for k, (label, freq) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0])), 1):
            want[col, label] = (freq, k)
    assert got == want
    assert {r["label"] for r in E.vocabulary_table(log, ["u", "c"], ["m"], min_freq=3).collect()} == {"u1", "a"}
    df = spark.createDataFrame([("k1", "x", ["b", "?", None, "a"], "u2"), ("k2", None, None, "zz"), (None, "y", [], "u1")], "k string, c string, h array<string>, w string")
    coded = {r["k"]: r for r in E.encode_columns(df, "k", {"c": "c", "h": "m", "w": "u"}, table).collect()}
    assert (coded["k1"]["c"], coded["k1"]["h"], coded["k1"]["w"]) == (1, [2, 0, 0, 1], 2)
    assert (coded["k2"]["c"], coded["k2"]["h"], coded["k2"]["w"]) == (0, [0], 0)
    assert (coded[None]["c"], coded[None]["w"]) == (2, 1)


def test_state_survives_saving(spark, fitted, tmp_path):
    model, train, valid = fitted
    base = str(tmp_path / "a")
    assert model.save(spark, base) == 1
    loaded = A.InteractionModel.load(spark, base)
    assert loaded.spec == model.spec and rows(loaded.transform(valid)) == rows(model.transform(valid))
    assert rows(loaded.predict(valid).select("l_orderkey", "prob")) == rows(model.predict(valid).select("l_orderkey", "prob"))
    import glob
    import os
    os.truncate(sorted(glob.glob(f"{base}/v=1/items/part-*"))[0], 5)
    with pytest.raises(DamagedBundle):
        A.InteractionModel.load(spark, base)


def test_encoded_table(spark, fitted):
    model, train, valid = fitted
    fat = model.transform(valid)
    known = A.features(model.spec)
    assert fat.columns[-len(known):] == [f.name for f in known] and fat.columns[:2] == ["raw_o_custkey", "raw_l_partkey"]
    got = fat.collect()
    assert len(got) == valid.count() and all(r[f.name] is not None for r in got for f in known)
    for owner, of in (("user", model.spec.user_hist), ("item", model.spec.item_hist)):
        for c, stats in of.items():
            assert all(len(r[f"{owner}_{c}_hist"]) == len(r[f"{owner}_{c}_{s}"]) >= 1 for r in got for s in stats)


def test_new_records_get_defaults(spark, fitted):
    model, train, _ = fitted
    new = train.limit(1).withColumns({"o_custkey": F.lit(-1).cast("long"), "l_partkey": F.lit(None).cast("long"), "o_orderstatus": F.lit("?")}).drop("target")
    r = model.transform(new).first()
    assert r["raw_o_custkey"] == -1 and r["o_custkey"] == r["l_partkey"] == r["o_orderstatus"] == 0
    assert r["user_p_brand_hist"] == [0] and r["user_p_brand_mean"] == [0.0] and r["genres"] == [0] and r["n_genres"] == 0
    assert 0 < model.predict(new).first()["prob"] < 1


def test_padded_scores_equal_unpadded(spark, fitted):
    model, train, valid = fitted
    key = ["l_orderkey", "l_linenumber", "raw_l_partkey"]
    want = {tuple(r[k] for k in key): r["prob"] for r in model.predict(valid).collect()}
    for batch in (1000, 7):
        got = model.predict_padded(valid, batch=batch).collect()
        assert len(got) == len(want)
        assert all(abs(want[tuple(r[k] for k in key)] - r["prob"]) < 1e-9 for r in got)
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            model.predict_padded(valid, batch=bad)


def test_padding():
    col = pa.array([[1, 2, 3], None, [], [4]])
    out, n, real = padded(col)
    assert out.tolist() == [[1, 2, 3], [0, 0, 0], [0, 0, 0], [4, 0, 0]] and n.tolist() == [3, 0, 0, 1] and real.sum() == 4
    out, n, real = padded(col.slice(3))
    assert out.tolist() == [[4]]
    assert padded(pa.array([], pa.list_(pa.float64())))[0].shape == (0, 0)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2500))], names=["x"])
    parts = list(slices(iter([batch, batch.slice(0, 3)]), 1000))
    assert [p.num_rows for p in parts] == [1000, 1000, 500, 3]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(2500), 0, 1, 2]
    check_batch(1000)


def test_short_vocabularies_move_no_row(spark, monkeypatch):
    """columns of short vocabularies are coded where their rows lie, with the same ids as by the join."""
    df = spark.createDataFrame([(1, "a", ["x", None, "q"]), (2, None, []), (None, "z", None), (3, "", ["y", "x", "x"])], "k long, c string, h array<string>")
    table = spark.createDataFrame([("c", "a", 5, 2), ("c", "z", 7, 1), ("h", "x", 3, 1), ("h", "y", 1, 2)], "column string, label string, freq long, idx long")
    near = E.encode_columns(df, "k", {"c": "c", "h": "h"}, table)
    assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(str, near.collect()))
    twice = E.encode_columns(df.unionAll(df.where("k = 1")), "k", {"c": "c", "h": "h"}, table)
    assert sorted((r["k"], r["c"], tuple(r["h"])) for r in twice.collect() if r["k"] == 1) == [(1, 2, (1, 1, 0, 0, 0, 0))] * 2
    monkeypatch.setattr(E, "FEW_LABELS", 0)
    assert got == sorted(map(str, E.encode_columns(df, "k", {"c": "c", "h": "h"}, table).collect()))


def test_cut_is_compact_and_holds_any_column(spark):
    """A stage end is Parquet, of which readers take their columns; what Parquet cannot hold is checkpointed."""
    from featurelane.session import checkpoint_dir, cut_lineage
    cut = cut_lineage(spark.range(10).selectExpr("id", "array(id, null) a", "cast(id as string) `b c`"))
    assert cut.inputFiles() and all(checkpoint_dir(spark).split(":")[-1] in f for f in cut.inputFiles())
    assert sorted(r["id"] for r in cut.collect()) == list(range(10)) and cut.where("id = 3").first()["a"] == [3, None]
    odd = cut_lineage(spark.range(3).selectExpr("id", "null v", "id ID"))
    assert [c.lower() for c in odd.columns] == ["id", "v", "id"] and odd.count() == 3


def test_shown_values_are_made_in_the_profiles(spark):
    """what is shown or kept is chosen before the wide joins."""
    model, train, valid = flows._interaction(spark, SF)
    plain, narrow = model.transform(valid), model.transform(valid, lambda f, c: F.size(c) if f.kind in ("ids", "weights") else c)
    kinds = {f.name: f.kind for f in A.features(model.spec)}
    after = plain.select(*[F.size(c).alias(c) if kinds.get(c) in ("ids", "weights") else F.col(c) for c in plain.columns])
    assert sorted(map(str, narrow.collect())) == sorted(map(str, after.collect()))
    A.fit_classifier(model, train)
    names = ["l_orderkey", "l_linenumber"]
    few, all_ = model.predict_padded(valid, keep=names), model.predict_padded(valid)
    assert few.columns == [*names, "prob"] and "user_pos_query" not in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[:2] for r in few.collect()) == sorted((r["l_orderkey"], r["l_linenumber"]) for r in all_.collect())
    probs = [sorted(r["prob"] for r in x.collect()) for x in (few, all_)]
    assert max(abs(a - b) for a, b in zip(*probs)) < 1e-9
