"""Hyper-parameter search on a fixed split.

The prepared vectors of both parts are staged once; the trials are fitted by ``fitMultiple`` in a bounded number of
driver threads, so that the cluster works on several at a time, and all are judged together on the validation
part: one pass for regressions, one grouped ranking for classifiers.  The best model (a tie goes to the later
trial) is kept with its parameters, its metric and the whole list of trials, and saved as one versioned bundle.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.operators.metrics import auc_by, rmspe
from featurelane.plans.models import sample_params
from featurelane.session import cut_lineage
from featurelane.sources.bundle import open_bundle, save_bundle

#: The reference flows' numbers of trials by metric.
TRIALS = {"rmspe": 30, "auc": 10}


@dataclass
class Search:
    metric: str
    trials: list[dict]
    best: dict
    model: PipelineModel

    def save(self, spark: SparkSession, base: str) -> int:
        return save_bundle(spark, base, docs={"metric": self.metric, "trials": self.trials, "best": self.best}, models={"model": self.model})

    @classmethod
    def load(cls, spark: SparkSession, base: str, version: int | None = None) -> "Search":
        b = open_bundle(spark, base, version)
        return cls(b.doc("metric"), b.doc("trials"), b.doc("best"), b.model("model"))


def fit_trials(estimator: Estimator, train: DataFrame, draws: list[dict], threads: int) -> list[Model]:
    """One model per parameter map, ``threads`` at a time."""
    fits = estimator.fitMultiple(train, [{estimator.getParam(k): v for k, v in d.items()} for d in draws])
    with ThreadPoolExecutor(threads) as pool:
        found = dict(pool.map(lambda _: next(fits), draws))
    return [found[i] for i in range(len(draws))]


def judge(models: list[Model], valid: DataFrame, label: str, metric: str, log_target: bool) -> list[float | None]:
    """The metric of every model in one pass over the validation part."""
    if metric == "rmspe":
        out = valid
        for i, m in enumerate(models):
            out = m.copy({m.predictionCol: f"_p{i}"}).transform(out)
        row = out.agg(*[rmspe(label, f"_p{i}", log_target).alias(f"v{i}") for i in range(len(models))]).first()
        return list(row)
    out = valid
    for i, m in enumerate(models):
        out = m.copy({m.predictionCol: f"_c{i}", m.rawPredictionCol: f"_w{i}", m.probabilityCol: f"_p{i}"}).transform(out)
    scores = F.array(*[F.struct(F.lit(i).alias("trial"), vector_to_array(f"_p{i}")[1].alias("score")) for i in range(len(models))])
    long = out.select(label, F.explode(scores).alias("_s")).select(label, "_s.trial", "_s.score")
    found = {r["trial"]: r["auc"] for r in auc_by(long, "trial", label, "score").collect()}  # one row per trial
    return [found.get(i) for i in range(len(models))]


def search(train: DataFrame, valid: DataFrame, label: str, prepared: PipelineModel, estimator: Estimator, space: dict, metric: str = "rmspe",
           trials: int | None = None, threads: int = 4, seed: int = 42, log_target: bool = True) -> Search:
    """``trials`` draws from ``space`` (30 for RMSPE, 10 for AUC by default) on the given split."""
    draws = sample_params(space, TRIALS[metric] if trials is None else trials, seed)
    parts = [cut_lineage(prepared.transform(p).select(label, "features")) for p in (train, valid)]
    models = fit_trials(estimator, parts[0], draws, threads)
    values = judge(models, parts[1], label, metric, log_target)
    sign = 1 if metric == "rmspe" else -1
    best = None
    for i, v in enumerate(values):
        if v is not None and (best is None or sign * v <= sign * values[best]):
            best = i
    if best is None:
        raise ValueError("no trial has a metric on the validation part")
    listed = [{"params": d, "value": v} for d, v in zip(draws, values)]
    return Search(metric, listed, listed[best], PipelineModel(stages=[*prepared.stages, models[best]]))
