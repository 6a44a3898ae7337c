"""spark.ml estimators on the prepared feature tables.

The neural estimators of the original flows have no spark.ml twin; they are
re-aimed at the closest distributed estimators (linear / GBT / logistic / ALS)
and claim the capability, not the published numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ridge(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
          alpha: float = 0.5, categories: DataFrame | None = None) -> PipelineModel:
    """M1: ridge ``||y - Xw||^2 + alpha ||w||^2`` on scaled numerics + dummies.

    Spark's normal-equation solver scales the penalty by the label's population
    std and by n, hence ``regParam = alpha * std_pop(y) / n``.  ``categories``
    (e.g. train union valid, labels only) fixes the dummy columns, so both
    parts share one encoding; by default the training rows define it.
    """
    st = train.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
    reg = alpha * (st["s"] or 1.0) / max(st["n"], 1)
    source = categories if categories is not None else train
    # one pass counts the labels of all columns
    idx = [StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__i" for c in categorical], handleInvalid="keep")
           .fit(source.select(*categorical))] if categorical else []
    indexed = PipelineModel(stages=idx).transform(train)
    ohe = [OneHotEncoder(inputCols=[f"{c}__i" for c in categorical], outputCols=[f"{c}__v" for c in categorical],
                         dropLast=False, handleInvalid="keep")] if categorical else []
    vec = VectorAssembler(inputCols=list(numeric) + [f"{c}__v" for c in categorical], outputCol="features",
                          handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=0.0, regParam=reg,
                          standardization=False, solver="normal")
    rest = Pipeline(stages=[*ohe, vec, lr]).fit(indexed)
    return PipelineModel(stages=[*idx, *rest.stages])


def wide_linear(train: DataFrame, label: str, hashed: Sequence[str], crosses: Sequence[str],
                buckets: int = 10000) -> PipelineModel:
    """M2: linear model over hashed categoricals and hashed crosses."""
    hasher = FeatureHasher(inputCols=list(hashed) + list(crosses), outputCol="features", numFeatures=buckets)
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=0.01, solver="l-bfgs")
    return Pipeline(stages=[hasher, lr]).fit(train)


def gbt_regressor(train: DataFrame, label: str, features: Sequence[str], max_iter: int = 20) -> PipelineModel:
    """M3 (re-aim of the deep regressor): gradient-boosted trees on the dense columns."""
    vec = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=5, seed=42)
    return Pipeline(stages=[vec, gbt]).fit(train)


def classifier(train: DataFrame, label: str, features: Sequence[str], reg: float = 0.0, ids: Sequence[str] = ()) -> PipelineModel:
    """M4: binary classifier over the fat table; ``ids`` (vocabulary numbers) as sparse indicators (E10), not as quantities."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, maxIter=50)
    return Pipeline(stages=[*vectors(features, ids), lr]).fit(train)


def vectors(numeric: Sequence[str], ids: Sequence[str] = ()) -> list:
    """Stages that make ``features`` of numbers and of sparse indicators of vocabulary ids; ids not seen in fitting are all zeros."""
    ohe = [OneHotEncoder(inputCols=list(ids), outputCols=[f"{c}__v" for c in ids], handleInvalid="keep")] if ids else []
    return [*ohe, VectorAssembler(inputCols=[*numeric, *[f"{c}__v" for c in ids]], outputCol="features", handleInvalid="keep")]


def als_factors(interactions: DataFrame, user: str, item: str, rating: str, rank: int = 8):
    """M5 part 1: implicit-feedback ALS factors for users and items."""
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, implicitPrefs=True, seed=42,
              coldStartStrategy="drop", maxIter=8)
    m = als.fit(interactions)
    return m.userFactors.withColumnRenamed("id", user), m.itemFactors.withColumnRenamed("id", item)


def hybrid_features(df: DataFrame, user_f: DataFrame, item_f: DataFrame, user: str, item: str,
                    rank: int) -> DataFrame:
    """M5 part 2: element-wise product of user and item factors (R11) as columns."""
    j = (df.join(user_f.withColumnRenamed("features", "_uf"), user, "left")
           .join(item_f.withColumnRenamed("features", "_if"), item, "left"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), rank)
    prod = F.zip_with(F.coalesce("_uf", zero), F.coalesce("_if", zero), lambda a, b: a * b)
    j = j.withColumn("_p", prod)
    return j.select(*df.columns, *[F.col("_p")[i].cast("double").alias(f"mf_{i}") for i in range(rank)])


def probability(pred: DataFrame, name: str = "prob") -> DataFrame:
    """Positive-class probability as a plain double column."""
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(name, vector_to_array("probability")[1])


def predict_sales(model: PipelineModel, df: DataFrame, open_col: str, name: str = "pred") -> DataFrame:
    """Closed (open != '1', '' or null) -> 0, else ``round(expm1(prediction))`` half-even."""
    p = model.transform(df)
    return p.withColumn(name, F.when(F.col(open_col) == "1", F.bround(F.expm1("prediction"), 0)).otherwise(F.lit(0.0)))


def sample_params(space: dict, trials: int, seed: int = 42) -> list[dict]:
    """Draw parameter maps -- ``('log', lo, hi)``, ``('linear', lo, hi)``,
    ``('discrete', [..])`` -- deterministically from ``seed``."""
    import random
    rnd = random.Random(seed)
    out = []
    for _ in range(trials):
        p = {}
        for k, spec in space.items():
            kind = spec[0]
            if kind == "log":
                p[k] = math.exp(rnd.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "linear":
                p[k] = rnd.uniform(spec[1], spec[2])
            else:
                p[k] = rnd.choice(spec[1])
        out.append(p)
    return out


def route_features(columns: dict[str, str]) -> tuple[list[str], list[str]]:
    """Split a feature spec ``{column: kind}`` into the deep set (``dense``,
    ``indicator``) and the wide set (``hashed``, ``cross``)."""
    deep = [c for c, k in columns.items() if k in ("dense", "indicator")]
    wide = [c for c, k in columns.items() if k in ("hashed", "cross")]
    return deep, wide


class WideDeepModel:
    """M2 + M3 combined: wide linear prediction plus boosted trees on its residual."""

    def __init__(self, wide: PipelineModel, deep: PipelineModel):
        self.wide, self.deep = wide, deep

    def transform(self, df: DataFrame) -> DataFrame:
        w = self.wide.transform(df).withColumnRenamed("prediction", "_wide").drop("features")
        d = self.deep.transform(w)
        return d.withColumn("prediction", F.col("_wide") + F.col("prediction")).drop("_wide", "features")


def wide_and_deep(train: DataFrame, label: str, columns: dict[str, str], buckets: int = 10000,
                  max_iter: int = 10) -> WideDeepModel:
    """Re-aim of the wide-and-deep regressor: the wide part (hashed categoricals
    and crosses) is a linear model, the deep part (dense numerics and indexed
    indicators) fits gradient-boosted trees to what the wide part leaves over;
    the prediction is their sum, as the combined estimator sums its two heads."""
    deep_cols, wide_cols = route_features(columns)
    hashed = [c for c in wide_cols if columns[c] == "hashed"]
    crosses = [c for c in wide_cols if columns[c] == "cross"]
    wide = wide_linear(train, label, hashed, crosses, buckets)
    resid = wide.transform(train).withColumn("_resid", F.col(label) - F.col("prediction")).drop("prediction", "features")
    dense = [c for c in deep_cols if columns[c] == "dense"]
    ind = [c for c in deep_cols if columns[c] == "indicator"]
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in ind]
    vec = VectorAssembler(inputCols=dense + [f"{c}__i" for c in ind], outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol="_resid", maxIter=max_iter, maxDepth=4, seed=42)
    deep = Pipeline(stages=[*idx, vec, gbt]).fit(resid)
    return WideDeepModel(wide, deep)
