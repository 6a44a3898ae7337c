"""Versioned bundles and the serving stream: whole or absent versions, damage found, restarts without loss or repeats."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from featurelane.plans import sales as B
from featurelane.plans.flows import sales_inputs
from featurelane.sources.bundle import DamagedBundle, latest_version, open_bundle, save_bundle
from featurelane.sources.tables import Tables
from featurelane.streaming.serve import VersionedServing, read_stream


@pytest.fixture(scope="module")
def inputs(spark):
    return sales_inputs(Tables(spark, SF))


@pytest.fixture(scope="module")
def state(inputs):
    return B.train(*inputs, B.SalesSpec())[0]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_versions_are_whole_or_absent(spark, tmp_path):
    base = str(tmp_path / "b")
    assert latest_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        open_bundle(spark, base)
    df = spark.createDataFrame([(1, "a", [1.0]), (2, None, None)], "k int, s string, x array<double>")
    assert save_bundle(spark, base, {"t": df, "v/a": df}, {"d": {"k": [1, None]}}) == 1
    df.write.parquet(f"{base}/v=2/t")  # a writer that died before its manifest
    assert latest_version(spark, base) == 1
    assert save_bundle(spark, base, {"t": df.limit(1)}) == 3
    one, three = open_bundle(spark, base, 1), open_bundle(spark, base)
    assert three.version == 3 and three.frame("t").count() == 1
    assert rows(one.frame("t")) == rows(df) and one.frame("t").schema == df.schema
    assert one.doc("d") == {"k": [1, None]} and list(one.frames("v")) == ["a"]
    one.verify()
    with pytest.raises(KeyError):
        one.frame("d")
    with pytest.raises(FileNotFoundError):
        open_bundle(spark, base, 2)


@pytest.mark.parametrize("harm", ["gone", "cut", "altered", "added"])
def test_damaged_part_raises(spark, tmp_path, harm):
    base = str(tmp_path / "b")
    df = spark.range(1000).selectExpr("id", "cast(id as string) s")
    save_bundle(spark, base, {"t": df.repartition(3)})
    part = sorted(glob.glob(f"{base}/v=1/t/part-*"))[0]
    if harm == "gone":
        os.truncate(part, 0)
    elif harm == "cut":
        os.truncate(part, os.path.getsize(part) - 10)
    elif harm == "added":
        df.write.mode("append").parquet(f"{base}/v=1/t")
    if harm != "altered":
        with pytest.raises(DamagedBundle):
            open_bundle(spark, base)
        return
    bundle = open_bundle(spark, base)
    bundle.verify()
    bundle.parts["t"]["checksum"] = "1"  # as if the rows were others of the same size
    with pytest.raises(DamagedBundle):
        bundle.verify()


def test_sales_state_round_trip(spark, inputs, state, tmp_path):
    base = str(tmp_path / "sales")
    assert state.save(spark, base) == 1
    loaded = B.SalesState.load(spark, base)
    log = inputs[0]
    assert loaded.spec == state.spec and loaded.stats == state.stats and loaded.version == 1
    assert rows(loaded.predict(log)) == rows(state.predict(log))
    assert loaded.features(log).columns == ["date"] + [c for c in B.HEADER if c != "sales"]
    closed = loaded.predict(log).where("open != '1'")
    assert closed.count() and closed.where("pred != 0").count() == 0


def test_unknown_store_and_gaps_get_defaults(spark, state):
    new = spark.createDataFrame([(-5, "1", "2020-02-03", "1"), (1, None, "2020-02-03", None), (1, "1", None, "1")],
                                "Store int, DayOfWeek string, Date string, Open string")
    for c in ("Promo", "StateHoliday", "SchoolHoliday"):
        new = new.withColumn(c, F.lit(None).cast("string"))
    got = {(r["store"], r["date"]): r for r in state.predict(new).collect()}
    assert len(got) == 3 and all(r["pred"] is not None for r in got.values())
    assert got[1, "2020-02-03"]["pred"] == 0 and got[1, "2020-02-03"]["day_of_week"] == ""
    assert got[-5, "2020-02-03"]["store_type"] == "" and got[-5, "2020-02-03"]["month"] == "2"


def test_train_sees_the_training_part_alone(inputs):
    """Other sales in the validation days change neither means nor statistics."""
    log, store, states = inputs
    first = B.train(log, store, states, B.SalesSpec(), ["sales_mean"], [])
    late = first[2].select(F.col("store").alias("Store"), F.col("date").alias("Date"), F.lit(True).alias("_late"))
    other = log.join(late, ["Store", "Date"], "left").withColumn("Sales", F.when(F.col("_late"), F.col("Sales") * 100).otherwise(F.col("Sales")))
    second = B.train(other.drop("_late"), store, states, B.SalesSpec(), ["sales_mean"], [])
    assert {r["store"]: r["sales_mean"] for r in first[0].means.collect()} == pytest.approx({r["store"]: r["sales_mean"] for r in second[0].means.collect()})
    for c, s in first[0].stats.items():
        assert s == pytest.approx(second[0].stats[c])


class Interrupted(Exception):
    pass


def test_stream_equals_batch_through_failure_and_new_version(spark, inputs, state, tmp_path):
    """Six files, one a micro-batch.  The third fails after its rows are written, the run is restarted from its checkpoint,
    and a second version is saved before the fifth."""
    base, log = str(tmp_path / "s"), inputs[0].drop("Sales", "Customers")
    log.repartition(6, "Store", "Date").write.parquet(f"{base}/inbox")
    state.save(spark, f"{base}/bundle")
    stream = lambda: read_stream(spark, f"{base}/inbox", log.schema, max_files=1)

    class Failing(VersionedServing):
        def __call__(self, batch, epoch):
            super().__call__(batch, epoch)
            if epoch == 2:
                raise Interrupted

    first = Failing(spark, f"{base}/bundle", B.SalesState.load, f"{base}/out")
    with pytest.raises(Exception):
        first.run(stream(), f"{base}/checkpoint")
    assert first.loads == 1 and {r[0] for r in first.results().select("batch").distinct().collect()} == {0, 1, 2}

    class Renewing(VersionedServing):
        seen: list[int] = []

        def __call__(self, batch, epoch):
            if epoch == 4:
                state.save(spark, f"{base}/bundle")
            super().__call__(batch, epoch)
            self.seen.append(epoch)

    second = Renewing(spark, f"{base}/bundle", B.SalesState.load, f"{base}/out")
    second.run(stream(), f"{base}/checkpoint")
    assert second.seen == [2, 3, 4, 5] and second.loads == 2
    got = second.results()
    assert {(r["batch"], r["version"]) for r in got.select("batch", "version").distinct().collect()} == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (5, 2)}
    assert rows(got.drop("batch", "version", "features")) == rows(state.predict(log).select(*[c for c in got.columns if c not in ("batch", "version", "features")]))
    second.run(stream(), f"{base}/checkpoint")  # nothing new: nothing served
    assert second.seen == [2, 3, 4, 5]


def test_stream_without_version_fails(spark, inputs, tmp_path):
    log = inputs[0].drop("Sales", "Customers")
    log.limit(3).write.parquet(str(tmp_path / "in"))
    serving = VersionedServing(spark, str(tmp_path / "none"), B.SalesState.load, str(tmp_path / "out"))
    with pytest.raises(Exception):
        serving.run(read_stream(spark, str(tmp_path / "in"), log.schema), str(tmp_path / "c"))
