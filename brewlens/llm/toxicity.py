"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a whole text, each present or not: words (A-Z folded), their stems
(first four bytes, so inflected forms meet), word pairs, and skip-grams (a
word with the next but one, and the next but two).  Per-coordinate rates and the L1 bar leave few weights, so the model that is
broadcast stays compact.

Defined cases: null or empty text scores the intercept; duplicate rows score
alike; an empty table gives no rows; other columns are ignored; null labels
and labels without a document teach nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from brewlens.llm import ftrl
from brewlens.llm import quality_classifier as Q
from brewlens.llm import words as W

SETTINGS = ftrl.Settings(bits=20, alpha=1.0, l1=4.0)
TOXIC = 0.3
STEM = 4   # bytes of a word that inflected forms share


def features(texts, bits: int):
    """(doc, index, 1.0) of the distinct hashed n-grams and skip-grams."""
    w = W.words(texts, lower=True, stem=STEM)
    docs, values = [w.doc, w.doc], [W.combine([w.hash], 1), W.combine([w.shape], 9)]
    for gap in (1, 2, 3):
        same = w.doc[gap:] == w.doc[:-gap]
        docs.append(w.doc[gap:][same])
        values.append(W.combine([w.hash[:-gap][same], w.hash[gap:][same]], 1 + gap))
    doc, index, count = ftrl.grouped(np.concatenate(docs), np.concatenate(values) >> W.U(64 - bits), bits)
    return doc, index, np.ones(len(doc))


def classify(docs: DataFrame, labels: DataFrame, settings: ftrl.Settings = SETTINGS, flag: float = TOXIC) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (held out: crc32(id) mod 4 = 2)."""
    return Q.classify(docs, labels, label="toxic", held_out_of=(4, 2), settings=settings, accept=flag, features=features)
