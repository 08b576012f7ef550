"""Substring hits of a lexicon table against a scan of all pairs."""

import random

import pytest

from brewlens.operators import containment as CT
from test_plans import plan

TEXTS = ["The Apple pie, an APPLE tart", "pineapple", None, "", "a\nb apple\nPIE", "naïve café crème brûlée", "aaaaaaaaaaaa", "xyz",
         "日本語のコーヒー", "apple pie apple pie apple pie"]
TERMS = ["apple", "APPLE pie", "pie", "a", "", None, "apple", "\nb", "café crème", "aaaaaaaaa", "コーヒー", "not there at all", "xyz",
         "xyzz", "e\np", "pie, an apple tart"]


def brute(texts, terms):
    terms = {t.lower() for t in terms if t}
    return sorted((i, t) for i, x in enumerate(texts) for t in terms if x is not None and t in x.lower())


def frames(spark, texts, terms):
    return (spark.createDataFrame(list(enumerate(texts)), "id long, body string"),
            spark.createDataFrame([(t,) for t in terms], "term string"))


@pytest.mark.parametrize("q", [1, 3, 8])
def test_hits_equal_all_pairs(spark, q):
    docs, lexicon = frames(spark, TEXTS, TERMS)
    got = sorted(map(tuple, CT.substring_join(docs, "id", "body", lexicon, q=q).collect()))
    assert got == brute(TEXTS, TERMS)


def test_random_substrings_of_skewed_texts(spark):
    r = random.Random(3)
    texts = ["the same line again " * 3 + "".join(r.choice("abc ") for _ in range(r.randrange(0, 200))) for _ in range(150)]
    terms = []
    for t in texts[:60]:
        a = r.randrange(len(t))
        terms.append(t[a:a + r.choice([1, 2, 5, 9, 30])])
    terms += ["".join(r.choice("abc ") for _ in range(10)) for _ in range(60)]
    docs, lexicon = frames(spark, texts, terms)
    got = sorted(map(tuple, CT.substring_join(docs, "id", "body", lexicon).collect()))
    assert got == brute(texts, terms)


def test_terms_are_filed_under_their_rarest_gram(spark):
    docs, lexicon = frames(spark, ["common words here", "common words there", "common words anywhere rare"], ["common words anywhere rare"])
    index, sizes = CT.gram_index(docs, "id", "body", lexicon)
    row = index.first()
    assert sizes == [8] and row["gram"] not in "common words " and row["gram"] in row["term"]


def test_empty_sides_and_repeated_ids(spark):
    docs, lexicon = frames(spark, TEXTS, TERMS)
    assert CT.substring_join(docs, "id", "body", lexicon.limit(0)).count() == 0
    assert CT.substring_join(docs.limit(0), "id", "body", lexicon).count() == 0
    twice = spark.createDataFrame([(1, "an apple"), (1, "a pear"), (None, "apple")], "id long, body string")
    got = CT.substring_join(twice, "id", "body", spark.createDataFrame([("apple",)], "term string")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "apple"), (None, "apple")]


def test_no_nested_loop(spark):
    docs, lexicon = frames(spark, TEXTS, TERMS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            p = plan(CT.substring_join(docs, "id", "body", lexicon))
            assert "NestedLoop" not in p and "Cartesian" not in p and "Python" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_terms_with_spaces_among_others(spark):
    texts = ["we like the cold brew of the north", "a  b  c d", "the colds and the flu of it", "xx of", "of the", None, " lead and trail ",
             "naïve  café crème", "end at space ", "\ncold brew\nof the"]
    terms = ["e cold brew o", "of the nor", " of", "of ", "b  c", "  ", " ", "d the flu of", "ïve  café c", "at space ", "he cold", " lead and trail ",
             "cold brew\nof", "x of y", "like the warm brew"]
    docs, lexicon = frames(spark, texts, terms)
    for q in (1, 2, 3, 5, 8):
        got = sorted(map(tuple, CT.substring_join(docs, "id", "body", lexicon, q=q).collect()))
        assert got == brute(texts, terms), q


def test_documents_grams_are_not_shuffled_for_a_small_lexicon(spark, tmp_path):
    docs, lexicon = frames(spark, TEXTS, ["the apple pie", "no such words", "apple", "pie"])
    for name, df in (("docs", docs), ("lexicon", lexicon)):
        df.write.parquet(f"{tmp_path}/{name}")
    docs, lexicon = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("docs", "lexicon"))
    p = plan(CT.substring_join(docs, "id", "body", lexicon))
    assert "hashpartitioning(gram" not in p and "hashpartitioning(key" not in p


def test_grams_after_spaces_are_met_once_a_word(spark):
    text = "several words of about seven letters " * 20
    docs, lexicon = frames(spark, [text], ["words of about seven", "seven letters several"])
    filed, kinds = CT._filed(lexicon, "term", CT.Q)
    assert kinds == [(True, 8)]
    assert CT._gram_rows(docs, "id", "body", kinds).count() <= text.count(" ")
