"""Streams over several files (several micro-batches) equal their batch twins."""

from pyspark.sql import functions as F

from conftest import SF


def _inbox(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    path = str(tmp_path / "events")
    ev.repartition(4, "event_id").write.parquet(path)   # 4 files -> 4 micro-batches
    return ev, path


def test_running_vocab_over_batches(spark, tmp_path):
    from featurelane.streaming.serve import read_stream, vocab_counts_stream, vocab_merge_stream
    ev, path = _inbox(spark, tmp_path)
    items = F.get_json_object("props", "$.k").alias("item")
    want = {r["item"]: r["count"] for r in ev.select(items).groupBy("item").count().collect()}
    for fn in (vocab_counts_stream, vocab_merge_stream):
        src = read_stream(spark, path, ev.schema, max_files=1).select(items)
        got = {r["label"]: r["freq"] for r in fn(src, "item", spark).collect()}
        assert got == want, fn.__name__


def test_stateless_scoring_over_batches(spark, tmp_path):
    from featurelane.streaming.serve import read_stream, run_append, score_stream
    ev, path = _inbox(spark, tmp_path)
    prof = ev.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    src = read_stream(spark, path, ev.schema, max_files=1).select("event_id", "user_id")
    got = run_append(score_stream(src, [(prof, "user_id")], {"n": 0.0}), spark, "t")
    want = ev.select("event_id", "user_id").join(prof, "user_id", "left")
    assert got.count() == ev.count()
    assert got.select("event_id", "n").exceptAll(want.select("event_id", "n")).count() == 0
