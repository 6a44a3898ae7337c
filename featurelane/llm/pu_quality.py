"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives (label 1) and unlabelled web text are all that the fit sees of the classes, and the share of positives
in the unlabelled text is an estimated prior ``pi``.  With logistic loss l the risk is

    pi * E_P[l(+)] + max(0, E_U[l(-)] - pi * E_P[l(-)]):

the second part is the negatives' risk, estimated from the unlabelled less the positives in them.  Where that estimate
falls below 0 (which only over-fitting can do) its gradient is followed backwards, as in the non-negative estimator of Kiryo et al.

Texts are described by ``FEATURES`` numbers each: shape, characters, repetition and compression (``SHAPE``), and
the square roots of the shares of their words in ``WORDS`` buckets of a hash.  The model is a logistic regression on the standardised
features and the squares of the first.  The fit sees two samples of about ``SAMPLE`` documents each, a documented
bound, both chosen by hashes of the key: one of the documents with a trusted positive label, however few of all they are,
and one of all documents, which is the unlabelled text.

The prior is estimated from both samples' scores, so trusted positives alone are enough.  A logistic regression of positives against
unlabelled text, fitted on one half, scores the other.  Where only positives score, the unlabelled text's share
above a threshold is ``pi`` times the positives' share; the ratio is taken at the threshold at which its upper confidence bound is least
(best bin estimation of Garg et al.).

Results by case: a null text is empty, and is scored; labels that are null or of unknown documents are left out; a
document with several labels is positive if one is 1; without any positive document all scores are 0 (0.5 without
labels); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelane.llm.compression import dup_lines, repeat_words
from featurelane.llm.words import U, mix, row_blocks

SAMPLE = 20_000
ROUNDS = 400
SHAPE = 18
WORDS = 256
FEATURES = SHAPE + WORDS


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_KINDS = [_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class(b"0123456789"), _class(b"#*$%&"), _class(b"|<>"), _class(b"!"),
          _class(b".,;:?"), _class(bytes(range(128, 256))), _class(b"\n"), _class(b"@/\\_=+~^{}[]()")]


def word_shares(w) -> np.ndarray:
    """Square roots of the shares of each row's words in the buckets, one row of numbers for each row of texts."""
    n = np.diff(w.first)
    bucket = (mix(w.hash) >> U(32)).astype(np.int64) % WORDS
    counts = np.bincount(np.repeat(np.arange(len(n)), n) * WORDS + bucket, minlength=len(n) * WORDS)
    return np.sqrt(counts.reshape(len(n), WORDS) / np.maximum(n, 1)[:, None])


def matrix(w, compressor: zstandard.ZstdCompressor) -> np.ndarray:
    """The features of all rows of a block of texts."""
    shape = np.array([shape_features(w, r, compressor) for r in range(len(w.first) - 1)], np.float32).reshape(-1, SHAPE)
    return np.hstack([shape, word_shares(w).astype(np.float32)])


def shape_features(w, r: int, compressor: zstandard.ZstdCompressor) -> list[float]:
    """The numbers that describe row r of a block of texts."""
    raw = w.data[w.offsets[r]:w.offsets[r + 1]]
    words = w.of(r)
    n, size = len(words), max(1, len(raw))
    inside = w.inside[w.offsets[r]:w.offsets[r + 1]].sum()
    distinct = np.unique(words, return_counts=True)[1] if n else np.zeros(1)
    blob = raw.tobytes()
    lines = blob.count(b"\n") + 1
    return [np.log1p(n), inside / max(1, n), *(float(k[raw].mean()) if len(raw) else 0.0 for k in _KINDS),
            len(distinct) / max(1, n), float(distinct.max()) / max(1, n),
            float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0, repeat_words(words) / max(1, n),
            dup_lines(blob) / lines, n / lines / (1 + n / lines), len(compressor.compress(blob)) / (size + 16)]


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the features of every row, as the bytes of float32 numbers."""
    src = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=1)
        for batch, w in row_blocks(batches, "text"):
            x = matrix(w, compressor)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in x], pa.binary())], names=["key", "x"])

    return src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, x binary")


@dataclass
class Model:
    """Standardisation and weights; ``score`` gives probabilities."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        n = x.shape[1]
        squares = min(SHAPE, n)
        out = np.ones((len(x), n + squares + 1), np.float32)
        z = out[:, :n]
        np.subtract(x, self.mean, out=z, casting="unsafe")
        z /= self.scale.astype(np.float32)
        np.clip(z, -6, 6, out=z)
        out[:, n:-1] = z[:, :squares] ** 2 / 6
        return out

    def chance(self, design: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((design @ self.weights.astype(np.float32)).astype(float), -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.chance(self.design(x))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, rounds: int = ROUNDS, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Minimise the non-negative risk by full-batch Adam; without a prior, the risk of positives against unlabelled text."""
    n, width = len(positive) + len(unlabelled), positive.shape[1]
    mean = sum(v.sum(0, dtype=float) for v in (positive, unlabelled)) / n
    spread = np.sqrt(sum(((v - mean.astype(np.float32)) ** 2).sum(0, dtype=float) for v in (positive, unlabelled)) / n)
    model = Model(mean, np.maximum(spread, 1e-3), np.zeros(width + min(SHAPE, width) + 1))
    p, u = model.design(positive), model.design(unlabelled)
    m, v = np.zeros_like(model.weights), np.zeros_like(model.weights)
    for t in range(1, rounds + 1):
        sp, su = model.chance(p), model.chance(u)
        # gradients of the mean logistic losses: l(+) = -log s, l(-) = -log(1 - s)
        up = p.T @ (sp - 1).astype(np.float32) / len(p)
        down_p, down_u = p.T @ sp.astype(np.float32) / len(p), u.T @ su.astype(np.float32) / len(u)
        if prior is None:
            g = up + down_u
        else:
            negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            g = prior * up + down_u - prior * down_p if negative >= 0 else prior * down_p - down_u
        g = g + decay * np.append(model.weights[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        model.weights = model.weights - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def best_bin(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1, margin: float = 0.01) -> float:
    """The share of positives in the unlabelled text, from the scores of both."""
    at = np.unique(np.concatenate([positive, unlabelled]))
    p, u = (1 - np.searchsorted(np.sort(v), at, "left") / len(v) for v in (positive, unlabelled))
    at, p, u = at[p > 0], p[p > 0], u[p > 0]
    slack = sum(np.sqrt(np.log(4 / doubt) / 2 / len(v)) for v in (positive, unlabelled))
    best = int(np.argmin((u + (1 + margin) * slack) / p))
    return float(np.clip(u[best] / p[best], 1 / (len(unlabelled) + 1), 1.0))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in the unlabelled text: each half's scores come from a fit on the other half."""
    halves = [(v[::2], v[1::2]) if len(v) > 1 else (v, v) for v in (positive, unlabelled)]
    found = []
    for i in (0, 1):
        model = fit(halves[0][i], halves[1][i], None)
        found.append(best_bin(model.score(halves[0][1 - i]), model.score(halves[1][1 - i])))
    return float(np.mean(found))


def _share(key: str, seed: int, n: int, sample: int) -> Column:
    """Whether a hash of the key is among the share that gives ``sample`` of ``n`` rows."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30))


def train(docs: DataFrame, labels: DataFrame, training: Column, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE) -> tuple[Model | None, float]:
    """The model and the prior, from the rows of ``docs`` and ``labels`` where ``training`` (on the key) holds."""
    known = labels.where(training).where(F.col(label).isNotNull() & F.col(key).isNotNull())
    rows = docs.where(training).where(F.col(key).isNotNull()).select(key, text)  # other columns may have any names
    trusted = (known.where(F.col(label).cast("int") >= 1).select(F.col(key).alias("_k")).distinct()
               .join(rows.select(F.col(key).alias("_d")), F.col("_k") == F.col("_d"), "left_semi"))
    n = trusted.count()
    if not n:
        return None, 0.0 if known.take(1) else 0.5
    trusted = F.broadcast(trusted.where(_share("_k", 9, n, sample)).withColumn("p", F.lit(True)))  # about ``sample`` rows
    # the sample of all documents stands for the unlabelled text: its share of positives is the prior
    unlabelled = _share(key, 8, rows.count(), sample)
    met = rows.join(trusted, rows[key] == F.col("_k"), "left")
    picked = met.where(F.col("p") | unlabelled).select(key, text)
    features_of = feature_table(picked, key, text).withColumnRenamed("key", key)
    got = (features_of.join(trusted, features_of[key] == F.col("_k"), "left").select(F.col(key).alias("k"), "x", F.coalesce("p", F.lit(False)).alias("p"), unlabelled.alias("u"))
           .orderBy("k", "x").toPandas())  # twice ``sample`` rows at most, about
    p, u = got["p"].to_numpy(bool), got["u"].to_numpy(bool)
    x = np.frombuffer(b"".join(got.pop("x")), np.float32).reshape(-1, FEATURES)
    if not u.any():  # a sample of a few rows can be empty
        u = ~u
    if not p.any():
        return None, 0.5
    prior = estimate_prior(x[p], x[u])
    return fit(x[p], x[u], prior), prior


def score(docs: DataFrame, labels: DataFrame, training: Column, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key and score (0 to 1) of every row of ``docs``."""
    model, prior = train(docs, labels, training, key, text, **options)

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=1)
        for batch, w in row_blocks(batches, "text"):
            s = model.score(matrix(w, compressor)) if model else np.full(batch.num_rows, prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["key", "score"])

    src = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, score double").withColumnRenamed("key", key)
