"""Spelling variants against all pairs of the vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import frame, hostile_texts, rows

from brewlens.llm import spelling as S

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def brute_vocabulary(data):
    n = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(vocab):
    forms, out = {}, {}
    for w, n in vocab.items():
        close = [v for v in vocab if near(w, v)]
        best = min(close, key=lambda v: (-vocab[v], v), default=None)
        forms[w] = best if best is not None and vocab[best] >= 5 * n else None
        out[w] = len(close)
    told = []
    for w, n in vocab.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        told.append((w, forms[w], root, n, out[w], vocab[forms[w]] if forms[w] else None))
    return sorted(told)


def texts(seed):
    r = random.Random(seed)
    base = ["".join(r.choice(LETTERS[:40]) for _ in range(r.choice([6, 7, 7, 9, 14]))) for _ in range(30)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaab", "abcabcabc", "÷×÷×÷×", "x" * 70, "x" * 71, "x" * 70 + "y"]
    words = []
    for w in base:
        words += [w] * r.choice([5, 30, 700])
        for _ in range(6):
            at, c = r.randrange(len(w)), r.choice(LETTERS)
            words += [r.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w.upper()])] * r.choice([1, 5, 6, 40])
    r.shuffle(words)
    return [r.choice([" ", ", ", "1", "\n", "ł"]).join(words[a:a + 37]) for a in range(0, len(words), 37)]


def test_variants_equal_all_pairs(spark):
    data = rows(hostile_texts()[:-1] + texts(4)) + [(None, "secretary " * 9, "en", "s", 9), (3, "secretary secretari", "en", "s", 9)]
    got = S.variants(frame(spark, data, clash=True)).collect()
    want = brute_variants(brute_vocabulary(data))
    assert sorted(map(tuple, got), key=lambda r: r[0]) == want
    assert sum(1 for x in want if x[1]) > 20 and any(x[1] and x[1] != x[2] for x in want)


def test_a_filter_without_room_only_lets_more_through(spark):
    data = rows(texts(5))
    want = brute_variants(brute_vocabulary(data))
    assert sorted(map(tuple, S.variants(frame(spark, data), budget=1).collect()), key=lambda r: r[0]) == want


def test_filters_hold_every_word_and_few_others(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choice(LETTERS) for _ in range(r.choice([6, 9, 64, 65, 300]))) for _ in range(4000)})
    vocab = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    filters = S.build_filters(vocab)
    assert sum(f.nbytes for f in filters.values()) <= S.FILTER_BYTES
    for letters, at in S._by_length(words):
        codes = S._coded([words[k] for k in at])
        h = S._finish(S.place_values(np.broadcast_to(np.arange(letters), codes.shape), codes).sum(axis=1, dtype=np.uint64), letters)
        assert len(S.probe(filters, h, letters)) == len(at)
    other = np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert len(S.probe(filters, other, 9)) < 500
    small = S.build_filters(vocab, budget=4096)
    assert sum(f.nbytes for f in small.values()) <= 4096 + 32 * len(small)


def test_very_long_words_are_probed_in_blocks(spark):
    long = "ab" * 30_000
    data = rows([f"{long} {long}c"] * 6 + [long] * 40)
    got = {len(x.word): x for x in S.variants(frame(spark, data)).collect()}
    assert got[60_001].form == long and got[60_000].n_near == 1 and got[60_000].root == long


def test_empty_table(spark):
    assert S.variants(frame(spark, [])).count() == 0
    assert S.variants(frame(spark, rows([None, "", "few words here"]))).count() == 0
