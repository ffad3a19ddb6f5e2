"""Scores and numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sequence penalties, confidence weights and saturation points.
GAP, DUPLICATE, INVERSION = 0.15, 0.25, 0.30
FULL_ARTICLES, FULL_CHARS, FULL_TERMS = 10.0, 5000.0, 8.0

# Retry and pacing constants (milliseconds).
MAX_ATTEMPTS, BASE_DELAY_MS, MAX_DELAY_MS = 3, 2000, 30000
DELAY_STEP_MS = 500


def sequence_penalty_score(gaps: Column, duplicates: Column, inversions: Column) -> Column:
    return F.greatest(
        F.lit(0.0), F.lit(1.0) - (gaps * GAP + duplicates * DUPLICATE + inversions * INVERSION)
    )


def sequence_counts(indexes: Column, variant: str = "extractor") -> Column:
    """struct(gaps, duplicates, inversions) of an ordered index array.

    "extractor" looks at neighbours only; "qa" counts gaps and repeats over the whole set.
    """
    n = F.size(indexes)
    steps = F.zip_with(
        F.slice(indexes, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(indexes, 2, F.greatest(n - 1, F.lit(0))),
        lambda p, c: c - p,
    )

    def total(rule) -> Column:
        return F.aggregate(steps, F.lit(0), lambda acc, d: acc + rule(d))

    inversions = total(lambda d: (d < 0).cast("int"))
    if variant == "extractor":
        gaps = total(lambda d: F.when(d > 1, d - 1).otherwise(0))
        duplicates = total(lambda d: (d == 0).cast("int"))
    else:
        distinct = F.size(F.array_distinct(indexes))
        gaps = F.array_max(indexes) - F.array_min(indexes) + 1 - distinct
        duplicates = n - distinct
    return F.struct(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        duplicates.alias("duplicates"),
        inversions.alias("inversions"),
    )


def sequence_score(indexes: Column, variant: str = "extractor") -> Column:
    counts = sequence_counts(indexes, variant)
    score = sequence_penalty_score(counts["gaps"], counts["duplicates"], counts["inversions"])
    return (
        F.when(F.coalesce(F.size(indexes), F.lit(0)) <= 0, F.lit(0.0))
        .when(F.size(indexes) == 1, F.when(F.get(indexes, 0) == 1, F.lit(1.0)).otherwise(F.lit(0.8)))
        .otherwise(score)
    )


def strictly_sequential(indexes: Column) -> Column:
    """True for a non-empty array in which every index is its predecessor plus one."""
    expected = F.transform(indexes, lambda x, i: x - i)
    return (F.size(indexes) > 0) & (F.size(F.array_distinct(expected)) == 1)


def unknown_rate_penalty(rate: Column) -> Column:
    return (
        F.when(rate <= 0.10, rate * 2.0)
        .when(rate <= 0.30, F.lit(0.2) + (rate - 0.10) * 1.5)
        .when(rate <= 0.50, F.lit(0.5) + (rate - 0.30) * 1.5)
        .otherwise(F.least(F.lit(1.0), F.lit(0.8) + (rate - 0.50) * 0.4))
    )


def unknown_penalty(rate: Column, distinct_unknown: Column, variant: str = "extractor") -> Column:
    if variant == "extractor":
        extra = F.least(F.lit(0.2), distinct_unknown / F.lit(100.0) * 0.2)
    else:
        extra = (distinct_unknown > 100).cast("int") * 0.05 + (distinct_unknown > 200).cast("int") * 0.05
    return F.least(F.lit(1.0), unknown_rate_penalty(rate) + extra)


def length_score(chars: Column) -> Column:
    return F.least(chars / F.lit(FULL_CHARS), F.lit(1.0))


def confidence(n_articles: Column, sequence: Column, chars: Column, penalty: Column, terms: Column) -> Column:
    score = (
        F.least(n_articles / F.lit(FULL_ARTICLES), F.lit(1.0)) * 0.20
        + sequence * 0.20
        + length_score(chars) * 0.15
        + (F.lit(1.0) - penalty) * 0.25
        + F.least(terms / F.lit(FULL_TERMS), F.lit(1.0)) * 0.20
    )
    return F.when((chars > 0) & (n_articles > 0), score).otherwise(F.lit(0.0))


def delay_tier(rate: Column, previous: Column) -> Column:
    """Pause before the next request after a throttled reply."""
    return (
        F.when(rate >= 0.5, F.lit(5000))
        .when(rate >= 0.3, F.lit(2000))
        .when(rate > 0.1, F.lit(1000))
        .otherwise(F.greatest(F.lit(0), previous - DELAY_STEP_MS))
    )


def delay_reset(rate: Column) -> Column:
    """The absolute pause a rate sets, or null where the pause only decays."""
    return F.when(rate >= 0.5, F.lit(5000)).when(rate >= 0.3, F.lit(2000)).when(rate > 0.1, F.lit(1000))


def backoff_delay(attempt: Column, jitter: Column | None = None) -> Column:
    """Milliseconds to wait after a failed attempt (1-based)."""
    base = F.lit(BASE_DELAY_MS) * F.pow(F.lit(2.0), attempt - 1)
    return F.least(base + (jitter if jitter is not None else F.lit(0)), F.lit(MAX_DELAY_MS)).cast("int")


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("int")


def window_chunk_estimate(chars: Column, size: int, overlap: int, subtract: bool = True) -> Column:
    """Expected chunk count; `subtract` takes the overlap off the length first."""
    length = chars - overlap if subtract else chars
    return F.when(chars <= size, F.lit(1)).otherwise(F.ceil(length / (size - overlap)).cast("int"))
