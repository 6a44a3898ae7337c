"""Interaction-log flow: clean -> split -> prepare -> fit -> transform -> predict (pipeline A).

A log ``(user, item, context..., target)`` plus a user profile and an item profile become one encoded fat table:

* split first (W1, no leakage); everything below sees the training part alone;
* ``prepare``: one staged join of the log with the categorical attributes of both sides feeds all history triples of
  users and of items, each in one pass (A1-A3), the users' positive and negative item lists (A4) and the items' popularity
  (A5, N2);
* ``fit``: one vocabulary table for all columns (E2, E3), ranked per column, and population scalers per numeric, each on its
  own table (E6, E8); both profiles are encoded once (R6);
* ``InteractionModel.transform``: context ids, fat left joins with raw keys (J3, P4), defaults (N5), a declared header (P3).
  It is the same for training rows and for new records;
* ``InteractionModel.save`` / ``load``: the encoded profiles, the vocabulary, the scalers and the classifier as one versioned bundle.

Which vocabulary encodes a column, and which default a missing value gets, is declared: ``features(spec)`` is a typed
table of the header's columns (E16), not a guess from their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.operators import encoders as E
from featurelane.operators import history as H
from featurelane.operators.clean import fill_median
from featurelane.operators.joins import join_dim
from featurelane.operators.padded import check_batch, padded, slices
from featurelane.operators.split import activity_split
from featurelane.session import cut_lineage
from featurelane.sources.bundle import open_bundle, save_bundle

BOTH, COUNT = ["count", "mean"], ["count"]


@dataclass
class InteractionSpec:
    """Columns by role.  ``user_hist`` and ``item_hist``: the columns whose values an entity's history counts (and averages)."""

    user: str
    item: str
    target: str
    order: list[str]
    context: list[str]
    user_catg: list[str]
    user_numeric: list[str]
    item_catg: list[str]
    item_multi: list[str]
    item_numeric: list[str]
    item_plain: list[str] = field(default_factory=list)
    user_hist: dict[str, list[str]] = field(default_factory=dict)
    item_hist: dict[str, list[str]] = field(default_factory=dict)
    valid: float = 0.1

    def __post_init__(self):
        self.user_hist = self.user_hist or {c: COUNT for c in self.context} | {c: BOTH for c in [*self.item_catg, *self.item_multi]}
        self.item_hist = self.item_hist or {c: COUNT for c in self.context} | {c: BOTH for c in self.user_catg}


@dataclass(frozen=True)
class Feature:
    """One column of the header.

    ``kind``: ``id`` (a label's number), ``ids`` (an array of them), ``weights`` (an array aligned to ``ids``),
    ``number`` (scaled) or ``plain``.  ``vocab``: the column whose vocabulary encodes it.  ``owner``: log, user or item.
    """

    name: str
    kind: str
    owner: str
    vocab: str | None = None


def _history(owner: str, of: dict[str, list[str]]) -> Iterator[Feature]:
    for c, stats in of.items():
        yield Feature(f"{owner}_{c}_hist", "ids", owner, c)
        for s in stats:
            yield Feature(f"{owner}_{c}_{s}", "weights", owner)


def features(spec: InteractionSpec) -> list[Feature]:
    """The header in order, every column with its kind, its vocabulary and its owner."""
    out = [Feature(spec.user, "id", "user", spec.user), *[Feature(c, "id", "user", c) for c in spec.user_catg],
           *[Feature(c, "number", "user") for c in spec.user_numeric]]
    for way in ("pos", "neg"):
        out += [Feature(f"user_{way}_query_hist", "ids", "user", spec.item), Feature(f"user_{way}_query_count", "weights", "user")]
    out += _history("user", spec.user_hist)
    out += [Feature(spec.item, "id", "item", spec.item), *[Feature(c, "id", "item", c) for c in spec.item_catg],
            *[Feature(c, "ids", "item", c) for c in spec.item_multi], *[Feature(c, "number", "item") for c in spec.item_numeric],
            *[Feature(c, "plain", "item") for c in spec.item_plain], Feature("item_clicks", "number", "item"), Feature("item_pplrty", "number", "item")]
    out += _history("item", spec.item_hist)
    out += [Feature(c, "id", "log", c) for c in spec.context]
    names = [f.name for f in out]
    if len(set(names)) != len(names):
        raise ValueError(f"columns with two roles: {sorted({n for n in names if names.count(n) > 1})}")
    return out


def clean(log: DataFrame, spec: InteractionSpec) -> DataFrame:
    """Context categoricals -> ''."""
    return log.na.fill("", spec.context)


def split(log: DataFrame, spec: InteractionSpec) -> tuple[DataFrame, DataFrame]:
    """W1 activity-bounded split, before any feature is computed."""
    s = cut_lineage(activity_split(log, spec.user, spec.order, valid=spec.valid))  # stage end
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "valid").drop("split")


def _with_defaults(df: DataFrame, found: Sequence[Feature]) -> DataFrame:
    """Entities without history get [''] and [0.0]."""
    empty = {"ids": F.array(F.lit("")), "weights": F.array(F.lit(0.0))}
    return df.withColumns({f.name: F.when(F.size(f.name) > 0, F.col(f.name)).otherwise(empty[f.kind]) for f in found if f.kind in empty})


@dataclass
class Prepared:
    """The training log with categorical attributes, and both profiles with histories (labels, not yet numbers)."""

    fat: DataFrame
    users: DataFrame
    items: DataFrame


def prepare(train: DataFrame, users: DataFrame, items: DataFrame, spec: InteractionSpec) -> Prepared:
    """A1-A5 over one staged join of the training log with both sides' categorical attributes.

    A user's lists are bounded by the split, which leaves at most int(q75) rows of a user; an item's
    hold distinct values of user attributes and contexts, however many rows it has.
    """
    u, i, t = spec.user, spec.item, spec.target
    fat = train.join(users.select(u, *spec.user_catg), u, "left").join(items.select(i, *spec.item_catg, *spec.item_multi), i, "left")
    fat = cut_lineage(fat)  # stage end
    known = features(spec)
    # a user's rows are bounded, so they are brought together as they are, and not unpivoted first
    lists = H.polarity_arrays(fat.repartition(u), u, i, t, spec.order, "user")
    per_user = H.history_matrix(fat, u, spec.user_hist, t, "user", spec.item_multi, bounded=True).join(lists, u, "full")
    users_p = _with_defaults(join_dim(users, per_user, u), [f for f in known if f.owner == "user"])
    per_item = H.history_matrix(fat, i, spec.item_hist, t, "item", spec.item_multi).join(H.entity_popularity(fat, i, t, "item"), i, "full")
    items_p = _with_defaults(join_dim(items, per_item, i), [f for f in known if f.owner == "item" and f.name not in spec.item_multi])
    return Prepared(fat, cut_lineage(users_p), cut_lineage(fill_median(cut_lineage(items_p), ["item_clicks", "item_pplrty"])))


@dataclass
class InteractionModel:
    """Fitted state: encoded profiles, one vocabulary table, scalers and, once fitted, the classifier."""

    spec: InteractionSpec
    users: DataFrame
    items: DataFrame
    vocab: DataFrame
    scalers: dict[str, E.ScalerModel]
    model: PipelineModel | None = None
    version: int | None = None

    def save(self, spark: SparkSession, base: str) -> int:
        """Write the next version below ``base``."""
        return save_bundle(spark, base, {"users": self.users, "items": self.items, "vocab": self.vocab},
                           {"spec": asdict(self.spec), "scalers": {k: s.stats for k, s in self.scalers.items()}},
                           {"model": self.model} if self.model else {})

    @classmethod
    def load(cls, spark: SparkSession, base: str, version: int | None = None) -> "InteractionModel":
        b = open_bundle(spark, base, version)
        return cls(InteractionSpec(**b.doc("spec")), b.frame("users"), b.frame("items"), b.frame("vocab"),
                   {k: E.ScalerModel(s) for k, s in b.doc("scalers").items()}, b.model("model") if "model" in b.parts else None, b.version)

    def _default(self, f: Feature) -> Column:
        if f.kind == "number":
            s = next((x.stats[f.name] for x in self.scalers.values() if f.name in x.stats), None)
            return F.lit((s["median"] - s["mean"]) / s["std"] if s and s["median"] is not None else 0.0)
        return {"id": F.lit(0), "ids": F.array(F.lit(0)), "weights": F.array(F.lit(0.0)), "plain": F.lit(0)}[f.kind]

    def transform(self, log: DataFrame, show: Callable[[Feature, Column], Column] | None = None) -> DataFrame:
        """Log rows as raw keys, the log's other columns, and the header (training and new rows alike).

        ``show`` makes each feature's output column of its value; it is applied to the profiles, once for each entity and not for
        each log row, and to the defaults.  The items, whose rows are narrower, are joined first, so theirs are what the second join moves.
        """
        s, known = self.spec, features(self.spec)

        def shown(f: Feature, c: Column) -> Column:
            return F.when(c.isNotNull(), show(f, c)) if show else c

        def profile(df: DataFrame, owner: str, key: str) -> DataFrame:
            return df.select(key, *[shown(f, F.col(f.name)).alias(f.name) for f in known if f.owner == owner])

        out = log.withColumnsRenamed({s.user: f"raw_{s.user}", s.item: f"raw_{s.item}"})
        for c in s.context:
            out = E.encode(out, c, self.vocab.where(F.col("column") == c), c)
        out = join_dim(out, profile(self.items, "item", f"raw_{s.item}"), f"raw_{s.item}")
        out = join_dim(out, profile(self.users, "user", f"raw_{s.user}"), f"raw_{s.user}")
        keep = [f"raw_{s.user}", f"raw_{s.item}", *[c for c in log.columns if c not in (s.user, s.item, *s.context)]]
        value = {f.name: shown(f, F.col(f.name)) if f.owner == "log" else F.col(f.name) for f in known}
        return out.select(*keep, *[F.coalesce(value[f.name], shown(f, self._default(f))).alias(f.name) for f in known])

    def predict(self, log: DataFrame, name: str = "prob") -> DataFrame:
        """M4: the probability of a positive target for every log row."""
        from featurelane.plans.models import probability
        return probability(self.model.transform(pooled(self.transform(log), self.spec)), name)

    def predict_padded(self, log: DataFrame, name: str = "prob", batch: int = 1000, keep: Sequence[str] | None = None) -> DataFrame:
        """As ``predict``, in batches of at most 1,000 rows whose arrays are padded to the longest of the batch.

        ``keep``: the columns that come back beside the probability (all but the padded arrays by default); others that are not
        inputs are then not moved.
        """
        return _predict_padded(self.transform(log), self.spec, self.model, name, batch, keep)


def fit(p: Prepared, spec: InteractionSpec) -> InteractionModel:
    """The vocabularies over the training log, scalers per owner table, encoded profiles."""
    known = features(spec)
    vocab = cut_lineage(E.vocabulary_table(p.fat, [spec.user, spec.item, *spec.context, *spec.user_catg, *spec.item_catg], spec.item_multi,
                                           together=[[spec.user, *spec.user_catg], [spec.item, *spec.item_catg, *spec.item_multi], spec.context]))
    log = p.fat.select(spec.item).join(p.items.select(spec.item, "item_clicks", "item_pplrty"), spec.item, "left")
    scalers = {"users": E.fit_scaler(p.users, spec.user_numeric, ddof=0), "items": E.fit_scaler(p.items, spec.item_numeric, ddof=0),
               "log": E.fit_scaler(log, ["item_clicks", "item_pplrty"], ddof=0)}

    def profile(df: DataFrame, owner: str, key: str, own: list[E.ScalerModel]) -> DataFrame:
        mine = [f for f in known if f.owner == owner]
        coded = {f.name: f.vocab for f in mine if f.vocab}
        out = E.encode_columns(df.withColumn(f"raw_{key}", F.col(key)), f"raw_{key}", coded, vocab)
        for scaler in own:
            out = scaler.transform(out)
        return cut_lineage(out.select(f"raw_{key}", *[f.name for f in mine]))  # stage end

    return InteractionModel(spec, profile(p.users, "user", spec.user, [scalers["users"]]),
                            profile(p.items, "item", spec.item, [scalers["items"], scalers["log"]]), vocab, scalers)


# ------------------------------------------------------------------ classifier over the encoded table

def _pools(spec: InteractionSpec) -> list[tuple[str, str, str]]:
    """(name, ids, weights) of the mean-weighted histories; the id looked for is the log row's own value where it has one."""
    return [(f"pool_{o}_{c}", f"{o}_{c}_hist", f"{o}_{c}_mean") for o, of in (("user", spec.user_hist), ("item", spec.item_hist))
            for c, stats in of.items() if "mean" in stats]


def _numbers(spec: InteractionSpec) -> list[str]:
    return [f.name for f in features(spec) if f.kind == "number"]


def pooled(encoded: DataFrame, spec: InteractionSpec) -> DataFrame:
    """Every history's mean weight, and its weight at the row's own value (0 if not met), beside the scaled numbers."""
    cols, kinds = {}, {f.name: f.kind for f in features(spec)}
    for name, ids, weights in _pools(spec):
        cols[name] = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x) / F.size(weights)
        base = ids[ids.index("_") + 1:-len("_hist")]
        if kinds.get(base) == "id":
            cols[f"{name}_own"] = F.coalesce(F.aggregate(
                F.zip_with(ids, weights, lambda i, w: F.when(i == F.col(base), w).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    return encoded.withColumns(cols)


def pooled_names(spec: InteractionSpec) -> list[str]:
    kinds = {f.name: f.kind for f in features(spec)}
    out = []
    for name, ids, _ in _pools(spec):
        out += [name] + ([f"{name}_own"] if kinds.get(ids[ids.index("_") + 1:-len("_hist")]) == "id" else [])
    return out


def fit_classifier(model: InteractionModel, train: DataFrame) -> InteractionModel:
    """M4: a logistic regression over pooled histories and scaled numbers; the input is staged once for all iterations."""
    from featurelane.plans.models import classifier
    s = model.spec
    names = [*pooled_names(s), *_numbers(s)]
    rows = cut_lineage(pooled(model.transform(train), s).select(s.target, *names))
    model.model = classifier(rows, s.target, names)
    return model


def _predict_padded(encoded: DataFrame, spec: InteractionSpec, model: PipelineModel, name: str, batch: int, keep: Sequence[str] | None = None) -> DataFrame:
    check_batch(batch)
    fitted = model.stages[-1]
    weights, bias = fitted.coefficients.toArray(), float(fitted.intercept)
    pools, numbers, wanted = _pools(spec), _numbers(spec), pooled_names(spec)
    arrays = sorted({c for _, a, b in pools for c in (a, b)})
    own = {n[:-len("_own")]: True for n in wanted if n.endswith("_own")}
    bases = {n: ids[ids.index("_") + 1:-len("_hist")] for n, ids, _ in pools if n in own}
    if keep is None:
        schema = encoded.drop(*arrays).schema.add(name, "double")
    else:
        schema = encoded.select(*keep).schema.add(name, "double")
        inputs = dict.fromkeys([*keep, *arrays, *bases.values(), *numbers])
        encoded = encoded.select(*inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, batch):
            full = {c: padded(part.column(part.schema.get_field_index(c))) for c in arrays}
            x = []
            for n, ids, w in pools:
                x.append(full[w][0].sum(1) / full[w][1])
                if n in own:
                    value = part.column(part.schema.get_field_index(bases[n])).to_numpy(False)
                    x.append(np.where((full[ids][0] == value[:, None]) & full[ids][2], full[w][0], 0.0).sum(1))
            x += [part.column(part.schema.get_field_index(c)).to_numpy(False) for c in numbers]
            z = np.column_stack(x) @ weights + bias
            kept = [part.column(part.schema.get_field_index(f.name)) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-z)))], names=schema.names)

    return encoded.mapInArrow(run, schema)
