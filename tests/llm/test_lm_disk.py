"""Language-model scores: what the n-grams take on disk on their way to the buckets."""

import random

import numpy as np
import pytest
from helpers import frame, rows

from brewlens.llm import lm_score


def exchanged(plan):
    """Bytes written by every exchange of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return exchanged(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return exchanged(plan.plan())
    own = [plan.metrics().apply("shuffleBytesWritten").value()] if kind == "ShuffleExchangeExec" else []
    return own + [x for i in range(plan.children().size()) for x in exchanged(plan.children().apply(i))]


def test_bytes_exchanged_for_a_word(spark):
    r = random.Random(4)
    texts = [" ".join(f"w{int(r.paretovariate(0.5)):x}" for _ in range(400)) for _ in range(500)]
    scores = lm_score.score(frame(spark, rows(texts)), order=3)
    assert sum(x["n_words"] for x in scores.collect()) == 200_000
    last, answers, grams = exchanged(scores._jdf.queryExecution().executedPlan())
    print(f"bytes a word: {last / 200_000:.2f} {answers / 200_000:.2f} {grams / 200_000:.2f}")
    # most words back off to the end, and are not asked for in another bucket
    assert answers < 1.6 * 200_000
    assert last + answers + grams < 5.5 * 200_000


@pytest.mark.parametrize("dtype", [np.uint16, np.uint32, np.int64, np.uint64, np.float64])
def test_packed_arrays_come_back(dtype):
    r = np.random.default_rng(2)
    for n in (0, 1, 3, 1000):
        x = r.integers(0, 256, n * np.dtype(dtype).itemsize, np.uint8).view(dtype)
        assert lm_score.unpack(lm_score.pack(x), dtype).tobytes() == x.tobytes()
        if dtype != np.float64:
            for y in (x, np.sort(x)):
                assert (lm_score.unpack(lm_score.pack(y, True), dtype, True) == y).all()
    if dtype == np.uint64:
        assert len(lm_score.pack(np.sort(r.integers(0, 1 << 63, 20_000, dtype)), True)) < 7 * 20_000


def test_words_of_the_broadcast_table_are_places_in_it():
    heavy = lm_score.Heavy(np.array([9, 1, 5], np.uint64), np.array([3, 4, 2]), 9)
    for words in ([], [1, 2, 5, 9, 11], [2], [9], [11, 1 << 63]):
        words = np.array(words, np.uint64)
        packed, place = heavy.pack(words)
        assert (heavy.unpack(*packed)[place] == words).all()
