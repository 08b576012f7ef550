"""Keyed writes and metric rules from FIXTURES.md; idempotence."""

import datetime as dt

from pyspark.sql import functions as F

from brewlens.operators import extract as X
from brewlens.operators import metrics as M
from brewlens.operators import quality as Q
from brewlens.operators import upsert as U


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_insert_ignore_first_wins_and_idempotent(spark):
    target = spark.createDataFrame([(0, "old")], "id long, body string")
    batch = spark.createDataFrame([(1, "A", 0), (1, "B", 1), (0, "new", 2)], "id long, body string, seq int")
    once = U.insert_ignore(target, batch, ["id"], ["seq"])
    twice = U.insert_ignore(once, batch, ["id"], ["seq"])
    assert rows(once, "id", "body") == [(0, "old"), (1, "A")]
    assert rows(twice, "id", "body") == rows(once, "id", "body")


def test_partial_upsert_keeps_unlisted_columns(spark):
    target = spark.createDataFrame([(1, "t", "en", 7)], "id long, text string, language string, word_count int")
    upd = spark.createDataFrame([(1, "new", "xx", 9), (2, "n2", "en", 3)],
                                "id long, text string, language string, word_count int")
    out = U.upsert(target, upd, ["id"], ["text"])
    assert rows(out, "id", "text", "language", "word_count") == [(1, "new", "en", 7), (2, "n2", "en", 3)]
    assert rows(U.upsert(out, upd, ["id"], ["text"]), "id", "text", "language", "word_count") == \
        rows(out, "id", "text", "language", "word_count")


def test_update_from_keeps_stale_rows(spark):
    ft = spark.createDataFrame([(1, "a", 4), (2, "b", 0)], "id long, term string, total_mentions long")
    ex = spark.createDataFrame([(2, 0.9), (2, 0.4), (2, 0.6)], "flavor_term_id long, confidence_score double")
    assert rows(M.flavor_popularity(ft, ex), "id", "total_mentions") == [(1, 4), (2, 2)]


def test_mean_of_means_and_product_without_reviews(spark):
    products = spark.createDataFrame([(1, 10, 0, 0.0, 0, 3), (2, 10, 0, 0.0, 0, 0), (3, 10, 0, 0.0, 0, 3)],
                                     "id long, entity_id long, total_ratings long, avg_rating double, "
                                     "total_reviews long, mention_count long")
    products = products.withColumn("updated_at", F.lit(None).cast("timestamp"))
    reviews = spark.createDataFrame([(1, 5.0)] + [(2, 2.0)] * 9 + [(2, None)], "product_id long, overall_rating double")
    mentions = spark.createDataFrame([(3, "p", 10)], "coffee_product_id long, post_id string, roaster_id long")
    p = M.product_metrics(products, reviews, mentions)
    assert rows(p, "id", "total_ratings", "avg_rating", "mention_count") == [(1, 1, 5.0, 0), (2, 9, 2.0, 0), (3, 0, 0.0, 3)]
    ents = spark.createDataFrame([(10, "x")], "id long, name string").select(
        "id", "name", F.lit(0).cast("long").alias("product_count"), F.lit(0.0).alias("avg_product_rating"),
        F.lit(0).cast("long").alias("total_reviews"), F.lit(None).cast("timestamp").alias("updated_at"))
    e = M.entity_metrics(ents, p.where("id < 3"), mentions).first()
    assert (e["product_count"], e["avg_product_rating"], e["total_reviews"]) == (2, 3.5, 1)


def _fe(spark, sentiments, created="2024-02-01 00:00:00"):
    data = [(i, 1, "t", dt.datetime.fromisoformat(created), s, 0.75) for i, s in enumerate(sentiments)]
    return spark.createDataFrame(data, "id long, processed_review_id long, flavor_term_id string, "
                                       "created_at timestamp, sentiment double, confidence_score double") \
        .withColumn("post_id", F.col("id").cast("string"))


def test_positive_negative_counts(spark):
    r = M.flavor_rankings(_fe(spark, [0.3, 0.31, -0.3, -0.31, None]), None, "month", "2024-02-05").first()
    assert (r["mention_count"], r["positive_mentions"], r["negative_mentions"]) == (5, 1, 1)


def test_rank_ties_and_period(spark):
    df = spark.createDataFrame([("a", 9), ("b", 9), ("c", 4)], "flavor_id string, mention_count long") \
        .withColumn("period_type", F.lit("week")).withColumn("period_end", F.lit("2024-02-05"))
    assert rows(M.with_popularity_rank(df), "flavor_id", "popularity_rank") == [("a", 1), ("b", 1), ("c", 3)]
    assert M.period_days("quarter") == 365


def test_rankings_upsert_refreshes_only_listed_columns(spark):
    key = ("t", dt.date(2024, 1, 6), dt.date(2024, 2, 5), "month")
    stored = spark.createDataFrame([key + (3, 2, 0.1, 1, 0, dt.datetime(2024, 1, 1))],
                                   "flavor_id string, period_start date, period_end date, period_type string, "
                                   "mention_count long, unique_products long, avg_sentiment double, "
                                   "positive_mentions long, negative_mentions long, computed_at timestamp")
    fresh = spark.createDataFrame([key + (8, 5, 0.5, 3, 1, dt.datetime(2024, 2, 5))], stored.schema)
    r = M.upsert_rankings(stored, fresh).first()
    assert (r["mention_count"], r["avg_sentiment"], r["unique_products"], r["positive_mentions"]) == (8, 0.5, 2, 1)


def test_upper_median_and_hot_value(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    assert Q.upper_median(df, "x", "m").first()["m"] == 3.0
    skew = spark.range(0, 30001).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double"))
                                        .alias("x"))
    vals = sorted(r["x"] for r in skew.collect())
    assert Q.upper_median(skew, "x", "m").first()["m"] == vals[len(vals) // 2]


def test_upper_median_selection_loop(spark):
    df = spark.range(0, 5001).select(((F.col("id") * 7919) % 5003 / 3.0).alias("x"))
    vals = sorted(r["x"] for r in df.collect())
    assert Q.upper_median(df, "x", "m").first()["m"] == vals[len(vals) // 2]


def test_date_span_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),), (dt.datetime(2024, 1, 3, 1),)], "t timestamp")
    assert Q.date_span(df, "t").first()["span_days"] == 1


def test_first_k_then_filter(spark):
    data = [(1, i, 99 if i == 10 else (1 if i == 1 else 5)) for i in range(12)]
    df = spark.createDataFrame(data, "post long, seq int, score int")
    kept = Q.first_k_then_filter(df, "post", "seq", 10, F.col("score") >= 2)
    assert kept.count() == 9


def test_dedupe_keep_last(spark):
    df = spark.createDataFrame([("k", 1, 0), ("k", 2, 1)], "key string, score int, seq int")
    assert U.dedupe(df, ["key"], ["seq"]).first()["score"] == 2


def test_quality_flags(spark):
    posts = spark.createDataFrame([(60 if i < 80 else 1, "x" if i < 160 else "", 4) for i in range(400)],
                                  "score long, text string, n_comments long")
    flags = Q.quality_report(posts).first()["flags"]
    assert flags == ["low_total_count", "low_engagement", "few_comments", "lacking_body_text"]


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    last = U.dedupe(df, ["key"], ["seq"], keep="last")
    hot = last.where("key = -1").first()
    assert last.count() == n - n // 3 + 1 and hot["seq"] == n - 3 and hot["v"] == 2 * (n - 3)
    first = U.dedupe(df, ["key"], ["seq"], keep="first").where("key = -1").first()
    assert first["seq"] == 0
    target = spark.createDataFrame([(-1, 5, 5)], "key long, seq long, v long")
    merged = U.insert_ignore(target, df, ["key"], ["seq"])
    assert merged.count() == n - n // 3 + 1
    assert merged.where("key = -1").first()["v"] == 5


def test_rankings_without_review_join_match_join_path(spark):
    fe = _fe(spark, [0.5, -0.5, 0.1, 0.9]).withColumn("processed_review_id", F.col("id") % 2)
    fe = fe.withColumn("post_id", (F.col("id") % 2).cast("string"))
    reviews = spark.createDataFrame([(0, "0"), (1, "1")], "id long, post_id string")
    a = M.flavor_rankings(fe, reviews, "week", "2024-02-05").first().asDict()
    b = M.flavor_rankings(fe, None, "week", "2024-02-05").first().asDict()
    assert a == b and a["unique_products"] == 2


def test_upper_median_empty_input(spark):
    df = spark.createDataFrame([], "x double")
    assert Q.upper_median(df, "x", "m").first()["m"] is None


def test_upsert_reduces_duplicate_keys_without_an_order(spark):
    target = spark.createDataFrame([(1, "old")], "id long, v string")
    updates = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (None, "n")], "id long, v string")
    out = U.upsert(target, updates, ["id"], ["v"])
    assert sorted((str(r.id), r.v) for r in out.collect()) == [("1", "b"), ("2", "d"), ("None", "n")]
    again = U.insert_ignore(target, updates.repartition(7), ["id"])
    assert sorted((str(r.id), r.v) for r in again.collect()) == [("1", "old"), ("2", "c"), ("None", "n")]


def test_rollup_mean_ignores_missing_sentiment(spark):
    from brewlens.streaming import stream as ST
    rows = [("t", dt.datetime(2024, 2, 1, 5), 0.8), ("t", dt.datetime(2024, 2, 1, 6), None)]
    e = spark.createDataFrame(rows, "term string, created_at timestamp, sentiment double")
    closed = spark.createDataFrame([], ST._by_day(e, "created_at", "term", "sentiment").schema)
    r = ST.rollup_partials(ST.with_open_days(closed, e), "2024-02-05", 7).first()
    assert r["mention_count"] == 2 and abs(r["avg_sentiment"] - 0.8) < 1e-9


def test_lexicon_terms_of_any_length_match(spark):
    from brewlens.operators import extract as X
    docs = spark.createDataFrame([(1, "We drank a cold brew oat milk latte today"), (2, "cold brew")], "id long, text string")
    lex = spark.createDataFrame([("Cold brew oat milk",), ("latte",), ("",), (None,)], "term string")
    got = sorted(tuple(r) for r in X.lexicon_join(docs, "id", "text", lex).collect())
    assert got == [(1, "cold brew oat milk"), (1, "latte")]


def test_second_linking_run_adds_nothing(spark):
    from brewlens.operators import linktables as LT
    fact = "struct<term:string,context:string,intensity:string,sentiment:double,confidence:double,is_primary:boolean>"
    schema = (f"processed_review_id long, post_id string, flavors array<{fact}>, "
              "roasters array<struct<name:string,context:string>>, origins array<string>")
    ex = spark.createDataFrame([
        (1, "a", [("berry", "a berry", None, 0.5, 0.9, True)], [("Onyx Lab", "at Onyx Lab"), ("Onyx Lab", "again")], ["Kenya"]),
        (2, "b", [("zzz", None, None, None, None, None)], [("Onyx Labs", "x" * 500)], []), (3, "c", [], [], ["Peru", "Kenya"])], schema)
    rev = spark.createDataFrame([(i, [], [], []) for i in (1, 2, 3)], "id long, mentioned_flavor_ids array<long>, "
                                "mentioned_roaster_ids array<long>, mentioned_origins array<string>")
    terms = spark.createDataFrame([(7, "berry", "berry", [])], "id long, term string, normalized_term string, synonyms array<string>")
    ents = spark.createDataFrame([], "id long, entity_type string, name string, slug string, verified boolean")
    orig = spark.createDataFrame([(5, "Kenya", None, "kenya_general")], "id long, country string, region string, normalized_name string")
    t = LT.link_reviews(ex, rev, terms, ents, orig, spark.createDataFrame([], "processed_review_id long"))
    t = {k: v.cache() for k, v in t.items()}
    assert [(r.name, r.slug, r.verified) for r in t["entities"].collect()] == [("Onyx Lab", "onyx-lab", False)]
    m = sorted((r.post_id, r.mention_text, len(r.mention_context), r.confidence_score) for r in t["coffee_mentions"].collect())
    assert m == [("a", "Onyx Lab", 11, 0.7), ("b", "Onyx Labs", 500, 0.7)]
    done = {r.id: r for r in t["reviews"].collect()}
    assert done[1].mentioned_flavor_ids == [7] and len(done[1].mentioned_roaster_ids) == 2 and done[1].mentioned_origins == ["5"]
    assert done[2].mentioned_roaster_ids == done[1].mentioned_roaster_ids[:1] and len(done[3].mentioned_origins) == 2
    again = LT.link_reviews(ex, t["reviews"], terms, t["entities"], t["origins"], t["ledger"])
    assert again["coffee_mentions"].count() == again["flavor_extractions"].count() == 0
    for name in ("entities", "origins", "reviews", "ledger"):
        assert sorted(map(str, again[name].collect())) == sorted(map(str, t[name].collect()))


def test_dedupe_by_all_other_columns_carries_a_row_once(spark):
    rows = [(1, "a", [1, 2]), (1, "b", [1]), (1, "b", None), (None, "x", [3]), (None, None, [4]), (2, None, None)]
    df = spark.createDataFrame(rows, "id long, s string, v array<int>")
    for keep, want in (("last", {1: ("b", [1]), None: ("x", [3]), 2: (None, None)}), ("first", {1: ("a", [1, 2]), None: (None, [4]), 2: (None, None)})):
        one = U.dedupe(df, ["id"], ["s", "v"], keep)
        assert {r["id"]: (r["s"], r["v"]) for r in one.collect()} == want
        p = one._jdf.queryExecution().optimizedPlan().toString()
        assert "_by(" not in p


def test_extracted_posts_are_lowered_once(spark):
    posts = spark.createDataFrame([(1, "a title", "Sweet Kenyan berry. Drip it")], "id long, title string, body string")
    e = X.extract_posts(posts).select("flavors", "origins", "brew_methods", "word_count")
    p = e._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("AS _lowered") == 1 and "lower(cleaned_text" not in p and "lower(_lowered" not in p
    r = e.first()
    assert ([f["term"] for f in r["flavors"]], r["origins"], r["brew_methods"]) == (["berry", "sweet"], ["Kenya"], ["drip"])
