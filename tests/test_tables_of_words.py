"""Keywords folded in the row, sentiment from a lexicon table, and the catalog inventory."""

import random
import re
from collections import Counter

from brewlens.functions import lexicons as LX
from brewlens.functions import text as T
from brewlens.operators import extract as X
from brewlens.operators import quality as Q
from test_plans import plan

TEXTS = ["Great roast, not great water. The the THE roast!", "", None, "no words of blame", "never bad. not bad, bad", "a bad and stale cup",
         "good good good bad", "it's not good'n", "don't love"]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id long, body string")


def brute_keywords(text, n):
    words = [w for w in re.findall("[a-z]+", (text or "").lower()) if w not in set(LX.STOP_WORDS)]
    counts = Counter(words)
    order = sorted(counts, key=lambda w: (-counts[w], words.index(w)))[:n]
    return [(w, counts[w]) for w in order]


def test_keywords_equal_counting_by_hand(spark):
    r = random.Random(2)
    texts = TEXTS + [" ".join(r.choice(["mill", "roast", "bean", "the", "cup", "x"]) for _ in range(r.randrange(80))) for _ in range(40)]
    for n in (1, 3, 20):
        got = {}
        for row in X.keywords(docs(spark, texts), "id", "body", n).orderBy("doc_id", "rank").collect():
            got.setdefault(row["doc_id"], []).append((row["keyword"], row["cnt"]))
        assert got == {i: k for i, t in enumerate(texts) if (k := brute_keywords(t, n))}


def test_keywords_exchange_nothing(spark):
    kw = X.keywords(docs(spark), "id", "body")
    posts = X.extract_posts(spark.createDataFrame([(1, None, "A great roast with plum notes")], "id long, title string, body string"))
    both = X.with_keywords(posts)
    for df in (kw, both):
        assert "Exchange" not in plan(df) and "Python" not in plan(df)
    assert both.first()["keywords"] == [w for w, _ in brute_keywords("A great roast with plum notes", 20)]


def test_hook_and_plain_path_agree(spark):
    same = X.keywords(docs(spark), "id", "body", token_hook=lambda t: t).collect()
    assert sorted(map(tuple, same)) == sorted(map(tuple, X.keywords(docs(spark), "id", "body").collect()))


def test_sentiment_table_equals_the_generated_sql(spark):
    lexicon = spark.createDataFrame(LX.SENTIMENT_LEXICON + [("good", -9.0)], "word string, polarity double")
    got = {r["doc_id"]: r["sentiment"] for r in X.sentiment_join(docs(spark), "id", "body", lexicon).collect()}
    want = {r["id"]: r["s"] for r in docs(spark).select("id", T.sentiment("body").alias("s")).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v or 0.0, 9) for k, v in want.items()}
    assert any(v < 0 for v in got.values()) and any(v > 0 for v in got.values())


def test_sentiment_with_a_large_lexicon_has_no_nested_loop(spark):
    large = spark.range(100_000).selectExpr("concat('w', id) AS word", "double(id % 3 - 1) AS polarity")
    scored = X.sentiment_join(docs(spark, ["w1 w2 not w2"]).withColumnRenamed("body", "text"), "id", "text", large)
    assert "NestedLoop" not in plan(scored) and "Cartesian" not in plan(scored)
    assert scored.first()["sentiment"] == 0.0      # the tokens of the rule are letters only


def test_inventory_lists_the_catalog(spark):
    docs(spark).createOrReplaceTempView("inv_docs")
    docs(spark).limit(0).createOrReplaceTempView("inv_none")
    got = [tuple(r) for r in Q.inventory(spark, ["inv_none", "inv_docs", "inv_lost"]).collect()]
    assert got == [("inv_docs", "ok", len(TEXTS), "id,body", '{"id":"0","body":"' + TEXTS[0] + '"}'),
                   ("inv_lost", "missing", 0, None, None), ("inv_none", "empty", 0, "id,body", None)]
    spark.catalog.dropTempView("inv_docs")
    spark.catalog.dropTempView("inv_none")
