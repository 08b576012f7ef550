"""Language-model scores of higher orders against plain Python."""

import math
from collections import Counter

import pytest
from helpers import doc_words, frame, hostile_texts, rows

from brewlens.llm import lm_score


def brute_scores(data, order, alpha=0.4, least=2):
    count, total, starts = Counter(), 0, 0
    for _, t in data:
        w = ["<s>", *doc_words(t)]
        total += len(w) - 1
        count[("<s>",)] += len(w) > 1
        count.update(tuple(w[i - k + 1:i + 1]) for i in range(1, len(w)) for k in range(1, min(order, i + 1) + 1))

    def s(h, w):
        if not h:
            return count[(w,)] / total
        return count[(*h, w)] / count[h] if count[(*h, w)] >= least else alpha * s(h[1:], w)
    out = {}
    for i, t in data:
        w = ["<s>", *doc_words(t)]
        n, x = out.get(i, (0, 0.0))
        out[i] = (n + len(w) - 1, x + sum(math.log(s(tuple(w[max(0, j - order + 1):j]), w[j])) for j in range(1, len(w))))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("heavy,chunk", [(4096, 1 << 15), (3, 7)])
def test_scores_of_every_order(spark, monkeypatch, order, heavy, chunk):
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    monkeypatch.setattr(lm_score, "CHUNK", chunk)
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 5000)
    data = rows(hostile_texts()) + rows(["w1 w2 w3 w4 w5"] * 50, 1000) + [(7, "w1 twice", "en", None, 0), (None, "w1 w2", None, None, 0)]
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in lm_score.score(frame(spark, data, True), order=order).collect()}
    want = brute_scores([(d[0], d[1]) for d in data], order)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-6)
