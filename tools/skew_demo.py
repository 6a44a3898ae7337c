"""Skew diagnostic: give one user a third of the event log (derived from the
given events table) and compare the largest task of the plain window with the
largest slice of the skew-safe path.

usage: python tools/skew_demo.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from featurelane.operators.ordered import _sliced, number_within
    from featurelane.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    # keep all 16 shuffle partitions visible (no AQE coalescing) so task sizes compare
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "user_id")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    total = hot.count()

    w = hot.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    # rows per task after the window (rn is used, so the window is not pruned away)
    per_task = (w.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n"), F.max("rn").alias("deepest"))
                 .agg(F.max("n"), F.max("deepest")).first()[0])

    sliced = _sliced(hot, ["user_id"], [F.col("ts"), F.col("event_id")], 16)
    per_slice = sliced.groupBy("_blk").count().agg(F.max("count")).first()[0]

    a = w.select("event_id", F.col("rn").cast("long"))
    b = number_within(hot, ["user_id"], ["ts", "event_id"], "rn", 16, max_group_rows=0).select("event_id", "rn")
    same = a.exceptAll(b).count() == 0
    print(f"rows={total} hot_user_rows={total // 3} largest_window_task={per_task} "
          f"largest_slice={per_slice} same_numbering={same}")


if __name__ == "__main__":
    main()
