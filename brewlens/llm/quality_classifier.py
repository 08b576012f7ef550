"""Quality classifier: hashed word n-gram logistic regression trained by FTRL updates.

Features of a whole text: words, word pairs and the shapes of words (letters,
capitals and digits folded to one mark each, so ``Thiwh&&&`` and ``edan&&&``
meet), plus shape pairs that say whether both words are the same.  A feature's
value is ``sqrt(count / words)``, so a document's vector has a bounded length
whatever the text's.  Scores are sparse dot products over all documents.

Defined cases: null or empty text has no features and scores the intercept;
duplicate rows score alike; an empty table gives no rows; columns other than
doc_id and text are ignored; a null label or label without document teaches
nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm import ftrl
from brewlens.llm import words as W
from brewlens.llm.common import crc_of_id, prepare

SETTINGS = ftrl.Settings(bits=18, alpha=1.0, l1=0.1, l2=0.01)
ACCEPT = 0.3


def features(texts, bits: int):
    """(doc, index, value) of the distinct hashed n-grams, sorted by doc and index."""
    n_docs = len(texts)
    w = W.words(texts, shapes=True)
    same = w.doc[1:] == w.doc[:-1]
    equal = (w.hash[1:] == w.hash[:-1]).astype(W.U)
    parts = [(w.doc, W.combine([w.hash], 1)),
             (w.doc, W.combine([w.shape], 2)),
             (w.doc[1:][same], W.combine([w.hash[:-1], w.hash[1:]], 3)[same]),
             (w.doc[1:][same], W.combine([w.shape[:-1], w.shape[1:], equal], 4)[same])]
    doc = np.concatenate([p[0] for p in parts])
    index = np.concatenate([p[1] for p in parts]) >> W.U(64 - bits)
    doc, index, count = ftrl.grouped(doc, index, bits)
    total = np.bincount(w.doc, minlength=n_docs)
    return doc, index, np.sqrt(count / np.maximum(1, total[doc]))


def fitted(docs: DataFrame, labels: DataFrame, label: str, held_out_of: tuple[int, int], settings: ftrl.Settings, features):
    """The model learned from the labels that are not held out."""
    prepare(docs.sparkSession)
    modulus, rest = held_out_of
    learn = labels.select("doc_id", F.col(label).alias("label")).filter(crc_of_id(F.col("doc_id")) % modulus != rest)
    return ftrl.fit(docs, learn, features, settings)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out_of: tuple[int, int] = (5, 0),
             settings: ftrl.Settings = SETTINGS, accept: float = ACCEPT, features=features) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Labels whose ``crc32(doc_id as text) mod held_out_of[0] = held_out_of[1]``
    are never learned from.
    """
    weights, bias = fitted(docs, labels, label, held_out_of, settings, features)
    modulus, rest = held_out_of
    scored = ftrl.score(docs, weights, bias, features, settings.bits)
    return scored.select("doc_id", F.coalesce(crc_of_id(F.col("doc_id")) % modulus == rest, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out_of: tuple[int, int] = (5, 0),
             settings: ftrl.Settings = SETTINGS, accept: float = ACCEPT, features=features) -> DataFrame:
    """The rows (all their columns) that the classifier does not reject."""
    weights, bias = fitted(docs, labels, label, held_out_of, settings, features)
    return ftrl.at_least(docs, accept, weights, bias, features, settings.bits)
