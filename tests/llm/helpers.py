"""Small hostile fixtures shared by the tests of this folder."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns whose names the operators use inside
CLASH = ["t", "words", "n", "row", "_row", "bits", "windows", "kept", "keep_id", "digest", "score", "region", "set_id",
         "shard", "cluster", "bucket", "probability", "weight", "topic", "dropped_id", "first_id", "n_tokens", "label",
         "component_id", "bin_id"]


def rows(texts, first_id=0):
    return [(first_id + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def frame(spark, data, clash=False):
    df = spark.createDataFrame(data, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})
    return df


def hostile_texts(seed=1):
    """Nulls, empties, white space, copies, near copies, repeated words and a very long text."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["The", "the", "é", "ß.", "of", "|", "日本"]
    base = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (1, 3, 5, 7, 12, 40, 60, 90, 200)]
    texts = [None, "", " \t\n\x0b\x0c\r ", *base, *base, base[5].upper()]
    for t in base[4:]:
        for _ in range(4):
            w = t.split()
            w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
    texts += ["same same " * 40, "a line.\n" * 30, " ".join(r.choice(vocabulary) for _ in range(30_000))]
    return texts


def doc_words(text):
    return WORD.findall(text or "")
