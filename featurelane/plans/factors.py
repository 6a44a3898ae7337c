"""M5: factorisation of the interactions, its factors as features of a classifier, without target or row leaks.

Users and items are numbered by their vocabularies first, so keys of any type and size work; ids without a number get
zero factors.  A training row's features come from folds that do not hold the row: its factors from an
ALS model of the other folds' interactions, its user's mean target from the other folds' sums.  Rows of
the validation part use the model and the means of the whole training part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelane.operators import encoders as E
from featurelane.plans.models import als_factors, hybrid_features
from featurelane.session import cut_lineage


def _fold(rows: DataFrame, key: list[str], folds: int) -> DataFrame:
    return rows.withColumn("_fold", F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int"))


def out_of_fold_factors(train: DataFrame, valid: DataFrame, user: str, item: str, target: str, key: list[str], rank: int = 8,
                        folds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Both parts with ``mf_0 .. mf_{rank-1}`` and ``user_mean``; ``key`` names a row."""
    users, items = (cut_lineage(E.frequency_vocab(train, c)) for c in (user, item))

    def numbered(rows: DataFrame) -> DataFrame:
        return E.encode(E.encode(rows, user, users, "_user"), item, items, "_item")

    first, last = cut_lineage(_fold(numbered(train), key, folds)), cut_lineage(numbered(valid))

    def factors(log: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = log.where("_user > 0 AND _item > 0").groupBy("_user", "_item").agg(F.count(F.lit(1)).cast("float").alias("_n"))
        return als_factors(pairs, "_user", "_item", "_n", rank)

    def features(rows: DataFrame, log: DataFrame) -> DataFrame:
        with_factors = hybrid_features(rows, *factors(log), "_user", "_item", rank)
        overall = log.agg(F.avg(target)).first()[0] or 0.0
        means = log.where("_user > 0").groupBy(F.col("_user").alias("_u")).agg(F.avg(target).alias("user_mean"))
        out = with_factors.join(means, F.col("_user") == F.col("_u"), "left").drop("_u", "_user", "_item")
        return out.na.fill({"user_mean": overall})

    parts = [features(first.where(F.col("_fold") == k), first.where(F.col("_fold") != k)) for k in range(folds)]
    seen = parts[0]
    for p in parts[1:]:
        seen = seen.unionByName(p)
    return cut_lineage(seen.drop("_fold")), cut_lineage(features(last, first))
