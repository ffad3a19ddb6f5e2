import pytest
from pyspark.sql import functions as F

from lexmill.functions import scoring


@pytest.mark.parametrize(
    "indexes,score",
    [
        ([1, 2, 3, 4], 1.0), ([1, 3, 5], 0.70), ([1, 2, 2, 3], 0.75), ([3, 2, 1], 0.40),
        ([1, 3, 3, 2], 0.30), ([1, 10], 0.0), ([1], 1.0), ([5], 0.8), ([1, 3, 2], 0.55), ([], 0.0),
    ],
)
def test_pairwise_sequence(column, indexes, score):
    arr = F.array(*[F.lit(i) for i in indexes]).cast("array<int>")
    assert column(scoring.sequence_score(arr)) == pytest.approx(score)


@pytest.mark.parametrize("indexes,score", [([1, 3, 2], 0.70), ([1, 2, 3], 1.0), ([1, 2, 2, 3], 0.75), ([2], 0.8)])
def test_set_sequence(column, indexes, score):
    arr = F.array(*[F.lit(i) for i in indexes])
    assert column(scoring.sequence_score(arr, "qa")) == pytest.approx(score)


@pytest.mark.parametrize("indexes,ok", [([1, 2, 3], True), ([2, 3], True), ([1, 3], False), ([2, 1], False), ([], False)])
def test_strict(column, indexes, ok):
    arr = F.array(*[F.lit(i) for i in indexes]).cast("array<int>")
    assert column(scoring.strictly_sequential(arr)) is ok


@pytest.mark.parametrize(
    "rate,count,penalty",
    [(0.05, 10, 0.12), (0.20, 50, 0.45), (0.40, 80, 0.81), (0.80, 200, 1.0), (0.15, 150, 0.475), (0.15, 250, 0.475), (0.0, 0, 0.0)],
)
def test_penalty(column, rate, count, penalty):
    assert column(scoring.unknown_penalty(F.lit(rate), F.lit(count))) == pytest.approx(penalty, abs=0.01)


def test_penalty_qa(column):
    assert column(scoring.unknown_penalty(F.lit(0.2), F.lit(150), "qa")) == pytest.approx(0.40)
    assert column(scoring.unknown_penalty(F.lit(0.2), F.lit(250), "qa")) == pytest.approx(0.45)


def test_confidence_is_zero_without_articles(column):
    zero = scoring.confidence(F.lit(0), F.lit(0.0), F.lit(100), F.lit(0.0), F.lit(3))
    full = scoring.confidence(F.lit(10), F.lit(1.0), F.lit(5000), F.lit(0.0), F.lit(8))
    assert column(zero) == 0.0
    assert column(full) == pytest.approx(1.0)


def test_delays(column):
    assert [column(scoring.backoff_delay(F.lit(a))) for a in (1, 2, 3, 5)] == [2000, 4000, 8000, 30000]
    assert [column(scoring.delay_tier(F.lit(r), F.lit(700))) for r in (0.5, 0.3, 0.2, 0.1)] == [5000, 2000, 1000, 200]


def test_chunk_estimates(column):
    assert column(scoring.token_estimate(F.lit("abcdefghi"))) == 2
    assert column(scoring.window_chunk_estimate(F.lit(2000), 1000, 100)) == 3
    assert column(scoring.window_chunk_estimate(F.lit(900), 1000, 100)) == 1
