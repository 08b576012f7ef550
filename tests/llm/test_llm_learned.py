"""Classifiers and the pipeline: held-out accuracy, edge cases, and a brute-force run."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import MEDIUM, SMALL
from helpers import doc_words, frame, hostile_texts, rows
from test_llm_sets import brute_best_fit, brute_join

import corpus_pipeline
from brewlens.llm import ftrl, mixing, packing, quality_classifier, toxicity
from brewlens.llm.queries import REGISTRY


def auc(pairs):
    pairs = sorted(pairs)
    ones = [k for k, (_, y) in enumerate(pairs) if y]
    n1, n0 = len(ones), len(pairs) - len(ones)
    return (sum(ones) - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    for name, label, modulus, rest, least in (("op9_quality_classifier", "quality", 5, 0, 0.97),
                                              ("op10_toxicity", "toxic", 4, 2, 0.85)):
        out = REGISTRY[name](spark, MEDIUM).collect()
        assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest) for r in out)
        held = [(r["score"], labels[r["doc_id"]][label]) for r in out if r["held_out"] and r["doc_id"] in labels]
        assert auc(held) > least, (name, auc(held))


def test_classifier_edges(spark):
    texts = ["good text here " + str(i) if i % 2 else "bad &&& bad### " + str(i) for i in range(80)] + hostile_texts()
    docs = frame(spark, rows(texts) + [(None, "no id", "en", "s", 0)], True)
    data = [(i, int(i % 2), None) for i in range(80)] + [(0, 0, None), (5, None, None), (None, 1, None), (9999, 1, None)]
    labels = spark.createDataFrame(data, "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(docs, labels).collect()
    assert len(out) == len(texts) + 1
    score = {x["doc_id"]: x["score"] for x in out}
    assert min(score[i] for i in range(1, 80, 2)) > max(score[i] for i in range(0, 80, 2))
    left = quality_classifier.accepted(docs, labels)
    assert left.columns == docs.columns
    want = Counter(x["doc_id"] for x in out if x["score"] >= 0.3)
    assert Counter(x["doc_id"] for x in left.collect()) == want
    # no labels: every score is one half
    assert {x["score"] for x in toxicity.classify(docs, labels).collect()} == {0.5}
    assert quality_classifier.classify(frame(spark, []), labels).count() == 0


def test_updates_follow_the_published_rule():
    """One coordinate at a time, against the rule written out."""
    s = ftrl.Settings(bits=3, alpha=0.7, beta=1.0, l1=0.2, l2=0.1)
    z, n = np.zeros(9), np.zeros(9)
    plain_z, plain_n = [0.0] * 9, [0.0] * 9
    r = random.Random(1)

    def weight(i):
        bar = 0.0 if i == 8 else s.l1
        if abs(plain_z[i]) <= bar:
            return 0.0
        sign = 1 if plain_z[i] > 0 else -1
        return -(plain_z[i] - sign * bar) / ((s.beta + plain_n[i] ** 0.5) / s.alpha + s.l2)
    for _ in range(50):
        index = sorted(r.sample(range(8), 3))
        value = [r.random() for _ in index]
        label = r.randrange(2)
        ftrl.learn(z, n, label, np.array(index), np.array(value), s)
        x = dict(zip(index, value)) | {8: 1.0}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
        for i in x:
            g = (p - label) * x[i]
            sigma = ((plain_n[i] + g * g) ** 0.5 - plain_n[i] ** 0.5) / s.alpha
            plain_z[i] += g - sigma * w[i]
            plain_n[i] += g * g
    assert np.allclose(z, plain_z) and np.allclose(n, plain_n)
    assert np.allclose(ftrl.solve(z, n, s, np.arange(9) == 8), [weight(i) for i in range(9)])


def test_features_of_nothing():
    for module in (quality_classifier, toxicity):
        doc, index, value = module.features(pa.array(["", None, " "]), 10)
        assert len(doc) == len(index) == len(value) == 0
        assert len(module.features(pa.array([], pa.string()), 10)[0]) == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_equals_a_plain_run(spark):
    """Every stage against plain Python on what the stage before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = mixing.written(stage(spark, docs, SMALL), "test-stage")
        if k < 4:
            assert out.columns == columns
            after = {r["doc_id"] for r in out.collect()}
        if k == 0:
            p = {r["doc_id"]: r["predicted"] for r in REGISTRY["op9_quality_classifier"](spark, SMALL).collect()}
            assert after == {i for i in before if p[i]}
        elif k == 1:
            assert after == set({r["text"]: i for i, r in sorted(before.items())}.values())
        elif k == 2:
            found = brute_join([(i, r["text"]) for i, r in sorted(before.items())])
            assert after == {int(i) for i, _, c in found if i == c}
        elif k == 3:
            p = {r["doc_id"]: r["kept"] for r in mixing.mix(docs).collect()}
            assert after == {i for i in before if p[i]}
        else:
            got = Counter()
            for r in out.collect():
                got[r["doc_id"]] += r["n_tokens"]
            assert got == {i: len(doc_words(r["text"])) + 1 for i, r in before.items()}
            kept = out.collect()
        docs = out
    again = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, kept)) and len(kept) > 0


def test_packing_of_a_shard_is_best_fit_decreasing(spark):
    r = random.Random(3)
    data = [(i, "w " * r.randrange(1, 90), "en", f"s{i % 4}", 0) for i in range(200)]
    out = packing.pack_documents(frame(spark, data), capacity=100, per_source=3, shard_docs=1000)
    cluster = {x["doc_id"]: x["cluster"] for x in out.collect()}
    sized = sorted(((len(d[1].split()) + 1, cluster[d[0]], d[3], d[0]) for d in data), reverse=True)
    sources, clusters = {}, {}
    items = [(n, sources.setdefault(s, len(sources)), clusters.setdefault(c, len(clusters))) for n, c, s, _ in sized]
    want = dict(zip((x[3] for x in sized), brute_best_fit(items, 100, 3)))
    assert {x["doc_id"]: x["bin_id"] for x in out.collect()} == want
