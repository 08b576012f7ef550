"""The two classifiers against plain Python: features, updates, scores and decisions."""

import math
import random
import zlib

import numpy as np
import pytest
from helpers import doc_words, frame, rows

from brewlens.llm import ftrl, quality_classifier, toxicity
from brewlens.llm import words as W

MASK = (1 << 64) - 1


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def value(byte):
    return mix(byte + 0x5851F42D4C957F2D)


def polynomial(data):
    return mix(sum(value(b) * pow(W.BASE, i, 1 << 64) for i, b in enumerate(data)) & MASK)


def combine(hashes, seed):
    total = None
    for k, h in enumerate(hashes):
        part = h * (((2 * k + 1) * 0xD6E8FEB86659FD93 + 2 * seed * 0xA0761D6478BD642F & MASK) | 1) & MASK
        total = part if total is None else ((total ^ total >> 29) * 0xFF51AFD7ED558CCD + part) & MASK
    return mix((total + seed) & MASK)


def low(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def shape(data):
    kinds = [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in data]
    return bytes(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k)


def quality_features(text):
    w = [x.encode() for x in doc_words(text)]
    h, s = [polynomial(x) for x in w], [polynomial(shape(x)) for x in w]
    found = [combine([x], 1) for x in h] + [combine([x], 2) for x in s]
    found += [combine(p, 3) for p in zip(h, h[1:])]
    found += [combine([s[i], s[i + 1], int(h[i] == h[i + 1])], 4) for i in range(len(w) - 1)]
    counts = {}
    for f in found:
        counts[f >> 64 - 18] = counts.get(f >> 64 - 18, 0) + 1
    return {f: math.sqrt(n / len(w)) for f, n in counts.items()}


def toxicity_features(text):
    w = [low(x.encode()) for x in doc_words(text)]
    h = [polynomial(x) for x in w]
    found = [combine([x], 1) for x in h] + [combine([polynomial(x[:4])], 9) for x in w]
    for gap in (1, 2, 3):
        found += [combine([h[i], h[i + gap]], 1 + gap) for i in range(len(w) - gap)]
    return {f >> 64 - 20: 1.0 for f in found}


def plain_scores(data, label, features, settings, modulus, rest):
    """FTRL-proximal, one document after the other in the order of the sample."""
    z, n = {}, {}

    def weight(i):
        bar = 0.0 if i == "bias" else settings.l1
        zi = z.get(i, 0.0)
        if abs(zi) <= bar:
            return 0.0
        return -(zi - math.copysign(bar, zi)) / ((settings.beta + math.sqrt(n.get(i, 0.0))) / settings.alpha + settings.l2)

    order = sorted((place, label[d], t or "") for d, t, place in data
                   if d in label and zlib.crc32(str(d).encode()) % modulus != rest)
    for _ in range(settings.epochs):
        for _, y, text in order:
            x = features(text) | {"bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - y) * x[i]
                grown = n.get(i, 0.0) + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(grown) - math.sqrt(n.get(i, 0.0))) / settings.alpha * w[i]
                n[i] = grown
    return [1 / (1 + math.exp(-sum(weight(i) * v for i, v in (features(t or "") | {"bias": 1.0}).items()))) for _, t, _ in data]


@pytest.mark.parametrize("module,column,features,modulus,rest", [
    (quality_classifier, "quality", quality_features, 5, 0), (toxicity, "toxic", toxicity_features, 4, 2)])
def test_scores_equal_plain_python(spark, module, column, features, modulus, rest):
    from pyspark.sql import functions as F
    r = random.Random(7)
    good, bad = [f"Word{i}" for i in range(30)], [f"bad{i}&&" for i in range(12)] + ["ÄÖ", "x1", "日本"]
    texts = [" ".join(r.choice(good + (bad if i % 3 == 0 else [])) for _ in range(r.choice([1, 4, 12, 40]))) for i in range(120)]
    data = rows(texts + [None, "", " \t"])
    docs = frame(spark, data)
    label = {i: int(i % 3 > 0) for i in range(0, 121)}
    labels = spark.createDataFrame([(i, y, y) for i, y in label.items()], "doc_id long, quality int, toxic int")
    place = {x["doc_id"]: x["p"] for x in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 32)).alias("p")).collect()}
    want = plain_scores([(d[0], d[1], place[d[0]]) for d in data], label, features, module.SETTINGS, modulus, rest)
    got = {x["doc_id"]: x for x in module.classify(docs, labels).collect()}
    for d, score in zip(data, want):
        assert got[d[0]]["score"] == pytest.approx(score, abs=1e-5)
        assert got[d[0]]["predicted"] == int(got[d[0]]["score"] >= 0.3)
        assert got[d[0]]["held_out"] == (zlib.crc32(str(d[0]).encode()) % modulus == rest)
    assert len({round(x, 3) for x in want}) > 20


def test_the_model_that_is_shared_holds_no_zero():
    weights = np.zeros(1 << 20)
    weights[[5, 900_000]] = [0.5, -2.0]
    known, values = ftrl.compact(weights)
    assert known.tolist() == [5, 900_000] and values.tolist() == [0.5, -2.0] and known.nbytes + values.nbytes == 16
