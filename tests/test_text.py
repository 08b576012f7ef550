"""FIXTURES.md hand rows for the text and extraction rules."""

import difflib

from pyspark.sql import functions as F

from brewlens.functions import text as T
from brewlens.operators import extract as X
from brewlens.operators import menu as MN


def one(spark, expr, value, ddl="t string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_clean_text(spark):
    assert one(spark, T.clean_text("t"), "  see https://a.b/c?d=1  now\n\nok ") == "see now ok"
    assert one(spark, T.clean_text("t"), "a www b") == "a"
    assert one(spark, T.clean_text("t"), "www.x.com is awww-some") == "is a"


def test_price(spark):
    assert one(spark, T.first_price("t"), "cost $ 5.999 or $7") == 5.99
    assert one(spark, T.first_price("t"), "paid $12") == 12.0
    assert one(spark, T.first_price("t"), "5 dollars") is None
    assert one(spark, T.first_price("t"), "$.50") is None


def test_post_text_min_length(spark):
    df = spark.createDataFrame([("hi", ""), (None, "a long enough body")], "title string, body string")
    kept = df.where(F.length(T.post_text("title", "body")) >= 10).count()
    assert kept == 1


def test_brand_pattern(spark):
    txt = ("I love Blue Bottle Coffee and Black Cat Coffee, also black cat. "
           "Black Cat Coffee again. Onyx Coffee.")
    df = X.roaster_facts(spark.createDataFrame([(txt,)], "t string"), "t")
    names = [r["name"] for r in df.first()["roasters"]]
    assert names == ["Blue Bottle", "Onyx", "Black Cat"]
    assert df.first()["roasters"][2]["context"] == ""


def test_intensity_confidence_primary(spark):
    d = spark.createDataFrame([("a strong but subtle rose taste. berry. prose and lemon here today ok.",)], "t string")
    facts = {f["term"]: f for f in X.flavor_facts(d, "t").first()["flavors"]}
    assert facts["rose"]["intensity"] == "subtle"
    assert facts["berry"]["intensity"] == "moderate"
    assert facts["berry"]["confidence"] == 0.6
    assert facts["rose"]["confidence"] == 0.75
    assert sum(f["is_primary"] for f in facts.values()) == 3


def test_primary_ties_follow_lexicon_order(spark):
    # confidences .6 .75 .75 .6 .75 -> the three .75 are primary
    text = ("cocoa. a long sentence with caramel in it. lime. another long sentence about toffee ok. "
            "and a long sentence with rose")
    facts = X.flavor_facts(spark.createDataFrame([(text,)], "t string"), "t").first()["flavors"]
    conf = {f["term"]: (f["confidence"], f["is_primary"]) for f in facts}
    assert sorted(c for c, _ in conf.values()) == [0.6, 0.6, 0.75, 0.75, 0.75]
    assert all(p for c, p in conf.values() if c == 0.75)
    assert not any(p for c, p in conf.values() if c == 0.6)


def test_substring_terms(spark):
    hits = one(spark, T.lexicon_hits("t", ["rose", "blueberry", "berry"]), "prose blueberry")
    assert hits == ["rose", "blueberry", "berry"]


def test_origins(spark):
    d = spark.createDataFrame([("kenyan colombian yemen yemeni",)], "t string")
    canon = X.origin_names(d, "t", "o", "canonical").first()["o"]
    compat = X.origin_names(d, "t", "o", "compat").first()["o"]
    assert canon == ["Kenya", "Colombia", "Yemen"]
    assert compat == ["Kenya", "Keya", "Colombia", "Yeme", "Yemeni"]


def test_normalize_slug_origin_key(spark):
    assert one(spark, T.normalize_name("t"), "Peet's Coffee-Co") == "peets coffee co"
    assert one(spark, T.slugify("t"), "Peet's Coffee Co") == "peets-coffee-co"
    df = spark.createDataFrame([("Peru", None), ("Peru", "Cusco")], "c string, r string")
    assert [r[0] for r in df.select(T.origin_key("c", "r")).collect()] == ["peru_general", "peru_cusco"]


def test_ratio_helper_matches_difflib():
    from brewlens.operators.link import _ratio
    for a, b in [("blue bottel", "blue bottle"), ("stumptwn", "stumptown"), ("peets", "peet's"),
                 ("heart", "hearts"), ("onyx coffee", "onyx")]:
        r = difflib.SequenceMatcher(None, a, b).ratio()
        assert _ratio(a, b) == (r if r > 0.85 else 0.0)


def test_menu_rules(spark):
    df = spark.createDataFrame([("Tea", "Iced Tea", "Black Tea"), ("X", "Cold Coffee", "X"),
                                ("X", "Frappuccino", "X")], "d string, cat string, name string")
    # rule A: "iced" in the name or "cold" in the category; (category, name) rows
    temps = [r[0] for r in df.select(MN.temperature(F.col("name"), F.col("cat"), "a")).collect()]
    assert temps == ["hot", "cold", "frozen"]
    b = spark.createDataFrame([("Iced Coffee", "X"), ("Frozen Drinks", "X"), ("Tea", "X")], "n string, c string")
    assert [r[0] for r in b.select(MN.temperature(F.col("n"), F.col("c"), "b")).collect()] == ["cold", "frozen", "hot"]
    caf = spark.createDataFrame([("decaf latte",), ("herbal tea",), ("water",)], "n string")
    assert [r[0] for r in caf.select(MN.has_caffeine(F.col("n"), F.lit(""), "a")).collect()] == [False, False, True]
    assert caf.select(MN.has_caffeine(F.col("n"), F.lit(""), "b")).collect()[1][0] is True
    assert one(spark, MN.sizes(F.col("t"), "a"), "nothing") == ["Tall", "Grande", "Venti"]
    assert one(spark, MN.calories(F.col("t")), "190 Calories per cup") == "190"


def test_menu_links_fallbacks(spark):
    html_dom = ('<a href="https://www.site.com/menu/product/123-abc">x</a>'
                '<a href="/en/menu/coffee">Coffee</a><a href="/en/menu/iced-coffee"> </a>'
                '<a href="/en/menu/coffee">Again</a><a href="/en/menu/tea/green">Green</a>')
    html_src = 'text /menu/product/zz-9 and /EN/MENU/tea/green-tea here'
    df = spark.createDataFrame([(1, "https://www.site.com/en/menu", html_dom), (2, "https://a.b/x", html_src)],
                               "page_id long, url string, html string")
    r = {x["page_id"]: x for x in MN.menu_links(df).collect()}
    assert r[1]["product_links"] == ["/menu/product/123-abc"]
    assert r[1]["item_links"] == ["/en/menu/tea/green"]
    assert [(c["path"], c["name"]) for c in r[1]["categories"]] == [
        ("/en/menu/coffee", "Coffee"), ("/en/menu/iced-coffee", "Iced Coffee")]
    assert r[2]["product_links"] == ["/menu/product/zz-9"]
    assert r[2]["item_links"] == ["/EN/MENU/tea/green-tea"]


def test_hooks(spark):
    posts = spark.createDataFrame([(1, None, "Apples and apples and pears, all good today.")],
                                  "id long, title string, body string")
    e = X.extract_posts(posts, sentiment_fn=lambda c: F.lit(0.25)).first()
    assert e["sentiment_score"] == 0.25
    kw = X.keywords(posts, "id", "body", token_hook=lambda t: F.when(t != "pears", F.regexp_replace(t, "s$", "")))
    assert [r["keyword"] for r in kw.orderBy("rank").collect()] == ["apple", "good", "today"]


def test_whole_word_option(spark):
    assert one(spark, T.lexicon_hits("t", ["rose", "berry", "cold brew"], whole_word=True),
               "prose, a blueberry and cold brew") == ["cold brew"]


def test_contexts_are_cut_only_where_asked(spark):
    long = "Chocolate " + "very " * 100 + "much at Stumptown"
    posts = spark.createDataFrame([(1, None, long)], "id long, title string, body string")
    cut, whole = X.extract_posts(posts).first(), X.extract_posts(posts, context_chars=None).first()
    assert len(cut["flavors"][0]["context"]) == len(cut["roasters"][0]["context"]) == 200
    assert len(whole["flavors"][0]["context"]) == len(whole["roasters"][0]["context"]) == len(long)


def test_sentiment_looks_a_token_up_once(spark):
    """One look-up of a token tells whether it is in the lexicon; texts without a word and null texts score 0."""
    d = spark.createDataFrame([(1, "not great, great"), (2, "great"), (3, ""), (4, None), (5, "no words here")], "id long, t string")
    scored = d.select("id", T.sentiment("t").alias("s"))
    assert "INSET" in scored._jdf.queryExecution().optimizedPlan().toString().upper()
    got = {r["id"]: r["s"] for r in scored.collect()}
    assert got[2] == 1.0 and got[1] == 0.25 and got[3] == got[4] == got[5] == 0.0


def test_edges_are_stripped_as_the_pattern_does_it_without_a_pass_of_the_pattern(spark):
    edges = ["", " ", "\t\n", "\x0b\f\r", "\u0085", " \u0085", " ", "  ", "\r\n", " ", "　 ", "\n\u0085\n"]
    rows = [(a + m + b,) for a in edges for b in edges for m in ("", "x", "a  b", "é\u0085\n y")] + [(None,)]
    d = spark.createDataFrame(rows, "s string").select("s", T.strip_column("s").alias("got"), F.regexp_replace("s", T.EDGE_WS, "").alias("want"))
    assert [r for r in d.collect() if r["got"] != r["want"]] == []


def test_urls_and_brands_are_found_as_the_patterns_find_them(spark):
    texts = ["see http://a.b/c now", "ww w", "www", "www.x y", "htt p", "", None, "awwwx  http", "Blue Bottle Coffee and Red Rock Coffee", "coffee Blue Cup",
             "Coffee", "Old Mill  Coffeehouse", "Big Old Mill\nCoffee"]
    d = spark.createDataFrame([(t,) for t in texts], "s string").select(
        T.clean_column("s").alias("clean"), T.brand_names("s").alias("brands"),
        F.regexp_replace(F.regexp_replace(F.regexp_replace("s", T.URL_PATTERN, ""), T.WS_RUN, " "), T.EDGE_WS, "").alias("clean_want"),
        F.regexp_extract_all("s", F.lit(T.BRAND_PATTERN), 1).alias("brands_want"))
    for r in d.collect():
        assert r["clean"] == r["clean_want"] and r["brands"] == r["brands_want"]


def test_words_within_words_are_hit_as_all_words_are(spark):
    words = ["bitter", "bitterness", "it", "berry", "blueberry", "x", ""]
    texts = ["Bitterness", "bitter it", "blue berry", "blueberry", "x", "", None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", T.lexicon_hits("s", words).alias("h")).collect()
    for r in got:
        assert r["h"] == [w for w in words if w and w in (texts[r["i"]] or "").lower()]
