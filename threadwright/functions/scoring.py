"""Heuristic quality scores of drafted replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import JUDGE_DIMENSIONS, STRONG_SIMILARITY, WEAK_SIMILARITY


def overall_score(*scores: Column) -> Column:
    """Mean of the dimensions, half-even on two decimals."""
    total = scores[0].cast("double")
    for score in scores[1:]:
        total = total + score
    return F.bround(total / len(scores), 2)


def heuristic_scores(similarity: Column, behavior_correct: Column) -> dict[str, Column]:
    grounded = (
        F.when(similarity >= STRONG_SIMILARITY, 5).when(similarity >= WEAK_SIMILARITY, 3).otherwise(2).cast("long")
    )
    relevance = F.when(F.coalesce(behavior_correct, F.lit(False)), 4).otherwise(2).cast("long")
    helpful = F.bround((grounded + relevance) / 2, 0).cast("long")
    safety = F.lit(5).cast("long")
    return {
        "relevance": relevance,
        "groundedness": grounded,
        "helpfulness": helpful,
        "safety": safety,
        "overall": overall_score(relevance, grounded, helpful, safety),
    }


def add_heuristic_scores(df, similarity_col: str = "top_similarity", correct_col: str = "behavior_correct"):
    scores = heuristic_scores(F.col(similarity_col), F.col(correct_col))
    return df.withColumns({name: scores[name] for name in [*JUDGE_DIMENSIONS, "overall"]})
