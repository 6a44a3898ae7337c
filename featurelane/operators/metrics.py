"""Model metrics (M7-M10) as aggregates over prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.operators.ordered import running_sums


def regression_metrics(df: DataFrame, y: str, pred: str, log_target: bool = False) -> DataFrame:
    """M7/M8: RMSPE over ``y > 0`` (positive targets only, P7), RMSE, MAE.

    With ``log_target`` the columns hold ``log1p`` values: RMSPE is taken on
    the ``expm1`` scale, RMSE and MAE on the log scale, as the original
    evaluation does.
    """
    yv, pv = F.col(y), F.col(pred)
    err = yv - pv
    ye, pe = (F.expm1(yv), F.expm1(pv)) if log_target else (yv, pv)
    return df.agg(F.sqrt(F.avg(F.when(ye > 0, ((ye - pe) / ye) ** 2))).alias("rmspe"),
                  F.sqrt(F.avg(err ** 2)).alias("rmse"), F.avg(F.abs(err)).alias("mae"))


def rmspe(y: str, pred: str, log_target: bool = False) -> Column:
    """M7 as one aggregate, so that many predictions are judged in one pass."""
    ye, pe = (F.expm1(y), F.expm1(pred)) if log_target else (F.col(y), F.col(pred))
    return F.sqrt(F.avg(F.when(ye > 0, ((ye - pe) / ye) ** 2)))


def auc_by(df: DataFrame, key: str, label: str, score: str) -> DataFrame:
    """M9 for every value of ``key`` at once; null where a group has one class only."""
    st = df.groupBy(key, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    cum = running_sums(st, [key], [F.col("score")], {"below": F.col("neg")})
    agg = cum.groupBy(key).agg(F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2)).alias("_hit"),
                               (F.sum("pos").cast("double") * F.sum("neg")).alias("_pairs"))
    return agg.select(key, F.when(F.col("_pairs") > 0, F.col("_hit") / F.col("_pairs")).alias("auc"))


def _score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """M9: one ROC point per distinct score (threshold), thresholds descending.

    Cumulative counts come from the skew-safe :func:`running_sums`.
    """
    st = _score_table(df, label, score)
    tot = st.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    cum = running_sums(st, [], [F.col("score").desc()], {"cpos": F.col("pos"), "cneg": F.col("neg")})
    return cum.select("score", (F.col("cpos") / F.lit(tot["P"])).alias("tpr"),
                      (F.col("cneg") / F.lit(tot["N"])).alias("fpr"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """M9: area under ROC by the rank formula, ties counted half."""
    st = _score_table(df, label, score)
    cum = running_sums(st, [], [F.col("score")], {"below": F.col("pos") + F.col("neg")})
    ranked = cum.withColumn("avg_rank", F.col("below") - (F.col("pos") + F.col("neg")) +
                            (F.col("pos") + F.col("neg") + 1) / 2.0)
    agg = ranked.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("rs"),
                     F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    return agg.select(((F.col("rs") - F.col("P") * (F.col("P") + 1) / 2) / (F.col("P") * F.col("N"))).alias("auc"))


def log_loss_from_logits(df: DataFrame, label: str, logit: str) -> DataFrame:
    """Mean sigmoid cross-entropy, numerically stable form."""
    z, y = F.col(logit), F.col(label).cast("double")
    return df.agg(F.avg(F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))).alias("logloss"))
