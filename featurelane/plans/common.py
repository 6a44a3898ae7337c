"""What the registered queries share: rounding, and the two logs built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelane.sources.tables import Tables, spread

R = 6  # decimals kept in float outputs


def _r(c):
    """Round a float output to ``R`` decimals, the same way in every engine.

    Sums of doubles differ in their last bits with the summation order, and a
    mean such as x.xxxxxx5 then rounds up in one engine and down in another.
    Snapping to 9 decimals as a DECIMAL first absorbs that noise; the final
    rounding is then decimal HALF_UP, which SQL engines agree on.  What no such
    DECIMAL holds (NaN, infinities, 1e30) stays as it is.
    """
    return F.coalesce(F.round(c.try_cast("decimal(38,9)"), R).cast("double"), c.cast("double"))


def event_log(t: Tables) -> DataFrame:
    """events as an interaction log: item = props.k, target = purchase."""
    return t.events.select(
        "user_id", "event_id", "ts",
        F.get_json_object("props", "$.k").alias("item"),
        (F.col("event_type") == "purchase").cast("int").alias("target"))


def lineitem_log(t: Tables) -> DataFrame:
    """lineitem as a log: user = o_custkey, item = l_partkey, target = returned."""
    li = spread(t.lineitem).select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_shipdate",
                           (F.col("l_returnflag") == "R").cast("int").alias("target"))
    od = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").drop("o_orderkey")
