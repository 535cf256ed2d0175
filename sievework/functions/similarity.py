"""Sample similarity: token-set overlap and length ratio in one number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def similarity(a: Column, b: Column, a_tokens: Column, b_tokens: Column) -> Column:
    """0 if either is empty, 1 if equal; half the length ratio if that is under a half or there are no
    tokens; else 0.8 of the Jaccard index of the token sets and 0.2 of the length ratio."""
    la, lb = F.length(a), F.length(b)
    ratio = F.least(la, lb) / F.greatest(la, lb)
    both = F.size(F.array_intersect(a_tokens, b_tokens))
    union = F.size(a_tokens) + F.size(b_tokens) - both
    return (
        F.when((la == 0) | (lb == 0) | a.isNull() | b.isNull(), F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .when((ratio < 0.5) | (F.size(a_tokens) == 0) | (F.size(b_tokens) == 0), ratio * 0.5)
        .otherwise(both / union * 0.8 + ratio * 0.2)
    )


def jaccard_floor(threshold: float) -> float:
    """Least Jaccard index at which the similarity can pass the threshold."""
    return (threshold - 0.2) / 0.8
