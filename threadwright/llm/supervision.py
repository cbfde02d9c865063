"""Quality rules as weak supervision: rules vote good or bad or abstain, and are weighed by EM.

A document's votes form a pattern; the counts of the patterns are all that the
expectation-maximisation needs, and their number is bounded by 3 to the number of rules however
many documents there are. It estimates, for each rule, how likely each vote is under a good and
under a bad document, and from that the posterior probability of good quality for each pattern.

Defined results: a null or empty text has all counts 0 and fails the base rules. With no document
the model is the prior. Ties at the cutoff are kept. Repeated rows are judged alike, each counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_chunks
from .stats import FEATURES, features

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Votes bad outside ``bad``, good inside ``good`` (None: never), and abstains otherwise."""

    name: str
    value: str  # SQL expression over the statistics
    good: tuple[float, float] | None
    bad: tuple[float, float]

    def vote(self) -> Column:
        v = F.expr(self.value)
        bad = F.when((v < self.bad[0]) | (v > self.bad[1]), -1)
        return (bad.when(v.between(*self.good), 1) if self.good else bad).otherwise(0)


BIG = 1e18
RULES = [
    Rule("word_length", "word_chars / greatest(n_words, 1)", None, (2.5, 12.0)),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", None, (0.0, 0.1)),
    Rule("symbol_characters", "symbol_share", None, (0.0, 0.02)),
    Rule("symbol_words", "symbol_word_share", None, (0.0, 0.1)),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", None, (0.0, 0.3)),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", None, (0.0, 0.4)),
    Rule("variety", "distinct_share * log10(greatest(n_words, 10))", (0.9, BIG), (0.35, BIG)),
    Rule("digits", "digit_share", None, (0.0, 0.2)),
    Rule("sentences", "stop_rate", (0.03, 0.25), (0.003, 0.6)),
    Rule("other_characters", "other_share", None, (0.0, 0.2)),
]


def text_statistics(df: DataFrame, text_col: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """The listed columns (default: all but the text) with the statistics the rules read."""
    longs, shares = [*BASE, "n_lines"], ["distinct_share", "digit_share", "stop_rate", "other_share", "symbol_share", "symbol_word_share"]
    made = [*longs, *shares]
    kept = [c for c in (df.columns if columns is None else columns) if c != text_col and c not in made]
    schema = T.StructType([df.schema[c] for c in kept])
    for name in longs:
        schema = schema.add(name, "long")
    for name in shares:
        schema = schema.add(name, "double")
    at = {name: i for i, name in enumerate(FEATURES)}

    def compute(batches):
        for batch in text_chunks(batches, text_col):
            base, x = features(batch.column(text_col))
            n = np.maximum(base["n_words"], 1)
            stats = [base[c] for c in BASE]
            stats.append(np.rint(np.expm1(x[:, at["line_rate"]]) * n / 100).astype(np.int64))
            stats.append(x[:, at["distinct_share"]])
            stats += [x[:, at[c]] ** 2 for c in ("digit_share", "stop_share", "other_share", "symbol_share", "symbol_word_share")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, stats)], names=[*kept, *made])

    return df.select(*dict.fromkeys([*kept, text_col])).mapInArrow(compute, schema)


@dataclass(frozen=True)
class VoteModel:
    """``likelihood[y, rule, vote + 1]`` and the prior share of good documents."""

    likelihood: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.prior, self.prior]))[:, None] + sum(
            np.log(self.likelihood[:, r, votes[:, r] + 1]) for r in range(votes.shape[1])
        )
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 100, strength: float = 0.02) -> VoteModel:
    """EM over distinct vote patterns and their counts.

    Each rule starts out right in most of its votes and keeps pseudo-counts (``strength`` of all
    documents) for that belief, so the two classes cannot swap and a rule that never votes one
    way stays defined.
    """
    rules = votes.shape[1]
    start = np.empty((2, rules, 3))
    start[0], start[1] = [0.4, 0.4, 0.2], [0.01, 0.49, 0.5]
    model = VoteModel(start, 0.8)
    total = counts.sum()
    if not total:
        return model
    onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    for _ in range(rounds):
        good = model.posterior(votes)
        weight = np.stack([(1 - good) * counts, good * counts])
        seen = np.einsum("yp,prv->yrv", weight, onehot) + strength * total * start
        likelihood = seen / seen.sum(axis=2, keepdims=True)
        prior = float((weight[1].sum() + 0.8 * strength * total) / (total * (1 + strength)))
        moved = abs(likelihood - model.likelihood).max() + abs(prior - model.prior)
        model = VoteModel(likelihood, prior)
        if moved < 1e-9:
            break
    return model


def judge_quality(statistics: DataFrame, rules: Sequence[Rule] = tuple(RULES), cutoff: float = 0.5) -> DataFrame:
    """Add ``quality_probability``, ``base_failed`` and ``kept``; ``statistics`` should be stored.

    Accuracies are estimated on the documents that pass the base rules: the others are dropped
    whatever the votes say. The pattern table (at most 3 ** len(rules) rows, 59,049 for the ten rules here) is joined by
    broadcast.
    """
    pattern = F.concat(*[F.substring(F.lit("-0+"), r.vote() + 2, 1) for r in rules])
    voted = statistics.withColumn("__votes", pattern)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    seen = sorted(voted.groupBy("__votes").agg(F.count(F.when(~failed, 1))).collect())
    code = {"-": -1, "0": 0, "+": 1}
    votes = np.array([[code[c] for c in row[0]] for row in seen], dtype=int).reshape(len(seen), len(rules))
    model = fit_votes(votes, np.array([row[1] for row in seen], dtype=float))
    rows = [(row[0], float(p)) for row, p in zip(seen, model.posterior(votes), strict=True)]
    table = statistics.sparkSession.createDataFrame(rows, "__votes string, quality_probability double")
    return (
        voted.drop("quality_probability", "base_failed", "kept")
        .join(F.broadcast(table), "__votes", "left")
        .drop("__votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= cutoff))
    )
