"""Periodic runs against a scan of every period, over tiles of several sizes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import doc_words, frame, hostile_texts, rows

from brewlens.llm import periodic_runs as R
from brewlens.llm import words as W


def brute_runs(w):
    """(start, length, period) of every run, by start, then period."""
    out, seen = [], set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q) and (s, i + q) not in seen:    # else a divisor of q repeats it
                seen.add((s, i + q))
                out.append((s, i + q - s, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(seed):
    r = random.Random(seed)
    texts = []
    for _ in range(40):
        w = [f"w{r.randrange(r.choice([1, 2, 4, 60]))}" for _ in range(r.choice([0, 5, 11, 12, 13, 40, 150, 500]))]
        if w and r.random() < .7:
            a = r.randrange(len(w))
            p = 1 + (len(w) - a) // r.choice([2, 3, 5, 9])
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 60 and r.random() < .5:
            w[r.randrange(len(w))] = "broken"
        texts.append(" ".join(w))
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    return texts + [" ".join(fib[-1]), " ".join("a" * 100 + "b" + "a" * 100 + "c" + "a" * 100 + "b")]


def long_texts():
    r = random.Random(8)
    base = [f"v{r.randrange(4000)}" for _ in range(60_000)]
    return [" ".join(base + base[:9000] * 3 + base[100:117] * 400)]


@pytest.mark.parametrize("tile_words", [16, 64, R.TILE_WORDS])
def test_fragments_of_tiles_stitch_to_all_runs(spark, tile_words):
    data = rows(hostile_texts()[:-1] + periodic_texts(1)) + rows(periodic_texts(2)[:5], 5)
    data += [(None, "x y " * 20, "en", "s", 80), (None, None, "en", "s", 0), data[12]]
    got = R.collapse(frame(spark, data, clash=True), tile_words).collect()
    told = sorted((str(g.doc_id), g.n_words, [tuple(x) for x in g.runs or []], g.collapsed_sha256) for g in got)
    want = []
    for doc_id, text, *_ in data:
        w = doc_words(text)
        runs = brute_runs(w)
        want.append((str(doc_id), len(w), runs, hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()))
    assert told == sorted(want)
    for g in got:
        assert (g.collapsed_text is None) == (not g.runs)


def test_very_long_text(spark):
    data = rows(long_texts())
    got = R.collapse(frame(spark, data)).first()
    runs = [tuple(x) for x in got.runs]
    w = data[0][1].split()
    assert runs == [(60_000, 27_000, 9000), (87_000, 6800, 17)]
    for s, n, q in runs:                # every one is a run: periodic, and no neighbour extends it
        assert w[s:s + n - q] == w[s + q:s + n]
        assert s == 0 or w[s - 1] != w[s + q - 1]
        assert s + n == len(w) or w[s + n] != w[s + n - q]
    assert got.collapsed_text == brute_collapsed(w, runs)


def test_many_fragments_of_one_run_in_tiles():
    ids = W.mix(np.tile(np.arange(1, 8, dtype=np.uint64), 300))
    found = R.fragments(ids, np.array([len(ids)]), 64)[0]
    assert len(found) > 20 and {q for q, _, _ in found} == {7}
    assert min(s for _, s, _ in found) == 0 and max(e for _, _, e in found) == 2100


def test_words_whose_hashes_collide_are_told_apart():
    words = [b"p", b"q", b"r"] * 10
    assert R._confirmed([(1, 0, 30)], words, 64) == [(3, 0, 30)]


def test_planted_rule_and_report(spark):
    texts = [t for t in periodic_texts(3) + hostile_texts()[:-1] + [" ".join(f"u{i}" for i in range(200))] * 60]
    data = rows(texts) + [(None, "a b c", "en", "s", 5)]
    got = {g.doc_id: g for g in R.report(R.planted(frame(spark, data))).collect()}
    assert len(got) == len(data)
    changed = 0
    for doc_id, text, *_ in data:
        w = doc_words(text)
        if doc_id is not None:
            h = zlib.crc32(str(doc_id).encode())
            if h % 10 == 0 and w:
                g, n = h // 10, len(w)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
                changed += 1
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        row = got[doc_id]
        assert (row.n_words, row.n_runs) == (len(w), len(runs))
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
    assert changed > 3


def test_empty_table_and_string_ids(spark):
    assert R.report(R.planted(frame(spark, []))).count() == 0
    df = spark.createDataFrame([("k", "a b " * 10)], "doc_id string, text string")
    assert [tuple(x) for x in R.collapse(df).first().runs] == [(0, 20, 2)]
