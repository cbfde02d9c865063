"""Quality classifier: regularised quadratic discriminant over document statistics.

Class means and covariances come from sums that every task forms over its labelled rows; only
those sums (a few hundred numbers) reach the driver. Covariances are shrunk towards the pooled
one and towards their diagonal, factored once (Cholesky), and a document's score is the logistic
of the difference of the two log densities.

Defined results: a null or empty text has the statistics of an empty text and is scored like any
other. A class without labelled rows gives every document the share of label 1 (0.5 without any
label). Labels that are null or other than 0 and 1 are ignored. Repeated rows are scored alike;
repeated labels count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_chunks
from .stats import FEATURES, features

CLIP = 8.0  # standard deviations beyond which a statistic counts as this far
FEATURES_COL = "features"


def text_features(df: DataFrame, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The listed columns (default: all but the text) and ``features``, an array of doubles."""
    kept = [c for c in df.columns if c not in (text_col, FEATURES_COL)] if columns is None else columns
    schema = T.StructType([df.schema[c] for c in kept]).add(FEATURES_COL, T.ArrayType(T.DoubleType()))

    def compute(batches):
        for batch in text_chunks(batches, text_col):
            _, x = features(batch.column(text_col))
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, FEATURES_COL])

    return df.select(*dict.fromkeys([*kept, text_col])).mapInArrow(compute, schema)


@dataclass(frozen=True)
class Discriminant:
    """``factors`` are Cholesky factors of the class covariances of standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_prior_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if not self.factors:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_prior_odds)))
        z = np.clip((x - self.centre) / self.scale, -CLIP, CLIP)
        logs = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            white = np.linalg.solve(factor, (z - mean).T)
            logs.append(-0.5 * (white**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.log_prior_odds, -40, 40)))


def fit_discriminant(
    labelled: DataFrame, label_col: str = "quality", to_pooled: float = 0.1, to_diagonal: float = 0.1, ridge: float = 1e-3
) -> Discriminant:
    """Learn from rows with ``features`` and a 0/1 label."""
    d = len(FEATURES)

    def moments(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for label in (0, 1):
                part = x[y == label]
                sums[label] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        n = sums.shape[1]
        yield pa.RecordBatch.from_pydict({"y": np.repeat([0, 1], n), "k": np.tile(np.arange(n), 2), "v": sums.ravel()})

    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("long").alias("y"), F.col(FEATURES_COL).alias("x"))
    total = rows.mapInArrow(moments, "y long, k long, v double").groupBy("y", "k").agg(F.sum("v").alias("v"))
    sums = np.zeros((2, 1 + d + d * d))
    for y, k, v in total.collect():  # 2 * (1 + d + d * d) rows
        sums[y, k] = v
    n = sums[:, 0]
    if n.min() < 2:
        return Discriminant(np.zeros(d), np.ones(d), (), (), float(np.log((n[1] + 1) / (n[0] + 1))))
    first, second = sums[:, 1 : 1 + d], sums[:, 1 + d :].reshape(2, d, d)
    centre = first.sum(axis=0) / n.sum()
    spread = second.sum(axis=0) / n.sum() - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-12))
    scale = np.where(scale < 1e-5, 1.0, scale)
    means, covs = [], []
    for label in (0, 1):
        mean = first[label] / n[label]
        cov = second[label] / n[label] - np.outer(mean, mean)
        means.append((mean - centre) / scale)
        covs.append(cov / np.outer(scale, scale))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    factors = []
    for cov in covs:
        shrunk = (1 - to_pooled) * cov + to_pooled * pooled
        shrunk = (1 - to_diagonal) * shrunk + to_diagonal * np.diag(np.diag(shrunk)) + ridge * np.eye(d)
        factors.append(np.linalg.cholesky(shrunk))
    return Discriminant(centre, scale, tuple(means), tuple(factors), float(np.log(n[1] / n[0])))


def score_quality(with_features: DataFrame, model: Discriminant, threshold: float = 0.3) -> DataFrame:
    """Replace ``features`` by ``score`` and ``predicted``."""
    kept = [c for c in with_features.columns if c not in (FEATURES_COL, "score", "predicted")]
    schema = T.StructType([with_features.schema[c] for c in kept]).add("score", "double").add("predicted", "integer")

    def apply(batches):
        for batch in batches:
            x = batch.column(FEATURES_COL).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            score = model.score(x)
            verdict = (score >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score), pa.array(verdict)], names=[*kept, "score", "predicted"])

    return with_features.select(*kept, FEATURES_COL).mapInArrow(apply, schema)
