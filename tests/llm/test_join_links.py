"""Link counts of the similarity join against all pairs."""

import random

import pytest
from helpers import doc_words, frame, rows

from brewlens.llm import ngram_join


def brute_links(data, percent=80, size=5):
    sets = []
    for _, text, *_ in data:
        w = doc_words((text or "").lower())
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return sets[i] and None not in (data[i][0], data[j][0]) and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
    return sorted((str(d[0]), sum(bool(linked(i, j)) for j in range(len(data)) if j != i)) for i, d in enumerate(data))


def chained():
    """A chain of texts, each near only its neighbours, a group of near copies, equal ones, and texts alone."""
    r = random.Random(3)
    line = [f"c{i}" for i in range(400)]
    texts = [" ".join(line[k * 8:k * 8 + 100]) for k in range(30)]
    base = [f"x{i}" for i in range(80)]
    for _ in range(60):
        w = list(base)
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = f"y{r.randrange(9)}"
        texts.append(" ".join(w))
    return rows(texts + [texts[0]] * 3 + ["one alone in the world of texts", "", None, "a b", "a b"])


@pytest.mark.parametrize("settings", [
    ngram_join.Settings(),
    ngram_join.Settings(region_shingles=500),                # regions are cut into blocks
    ngram_join.Settings(cell_members=3, pivots=2),           # regions are cut into cells
    ngram_join.Settings(region_shingles=900, cell_members=3, pivots=3),
])
def test_links_are_counted(spark, settings):
    data = chained()
    out = ngram_join.join(frame(spark, data, True), settings).collect()
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in out) == brute_links(data)
    counts = {r["n_links"] for r in out if r["component_id"] == 0}
    assert len(counts) > 2                                    # not what membership alone tells
