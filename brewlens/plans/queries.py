"""Registered queries: (spark, sf_dir) -> DataFrame, one per SURVEY 7.3 row.

Output columns are aliased to the names used by ``brewlens.plans.oracles``;
doubles that come out of sums/averages are rounded to 6 places (summation
order differs between engines), dates are ISO strings.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brewlens.operators import metrics as M
from brewlens.plans import standins as S

R = 6  # decimals kept for floating aggregates


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd")


def term_ranking(period: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fe = S.flavor_mentions_from_events(spark, sf_dir)
        pr = S.reviews_from_customer(spark, sf_dir)
        r = M.flavor_rankings(fe, pr, period, S.AS_OF)
        return r.select("flavor_id", _iso("period_start").alias("period_start"),
                        _iso("period_end").alias("period_end"), "period_type",
                        "mention_count", "unique_products",
                        F.round("avg_sentiment", 5).alias("avg_sentiment"),
                        "positive_mentions", "negative_mentions", "popularity_rank")
    return q


def _updated_flavor_terms(spark, sf_dir) -> DataFrame:
    return M.flavor_popularity(S.flavor_terms_from_part(spark, sf_dir),
                               S.flavor_extractions_from_lineitem(spark, sf_dir))


def term_popularity_update(spark, sf_dir):
    return _updated_flavor_terms(spark, sf_dir).select("id", "term", "total_mentions")


def top_terms(spark, sf_dir):
    return M.top_flavors(_updated_flavor_terms(spark, sf_dir), 10)


def flavors_with_mentions(spark, sf_dir):
    return M.flavors_with_mentions(_updated_flavor_terms(spark, sf_dir))


def _updated_products(spark, sf_dir):
    return M.product_metrics(S.products_from_part(spark, sf_dir),
                             S.product_reviews_from_lineitem(spark, sf_dir),
                             S.mentions_from_lineitem(spark, sf_dir), now=S.FIXED_NOW)


def product_metrics(spark, sf_dir):
    p = _updated_products(spark, sf_dir)
    return p.select("id", "entity_id", "total_ratings", F.round("avg_rating", R).alias("avg_rating"),
                    "total_reviews", "mention_count")


def entity_metrics(spark, sf_dir):
    e = M.entity_metrics(S.entities_from_part(spark, sf_dir), _updated_products(spark, sf_dir),
                         S.mentions_from_lineitem(spark, sf_dir), now=S.FIXED_NOW)
    return e.select("id", "name", "product_count",
                    F.round("avg_product_rating", R).alias("avg_product_rating"), "total_reviews")


def score_stats(spark, sf_dir):
    r = S.reviews_from_events(spark, sf_dir)
    st = M.review_stats(r)
    sc = r.agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"),
               F.round(F.avg("score"), R).alias("avg_score"))
    return M.one_row(st.withColumn("avg_sentiment", F.col("avg_sentiment").cast("double")), sc)


def coverage_counts(spark, sf_dir):
    return M.linking_coverage(S.reviews_from_documents(spark, sf_dir),
                              S.extractions_from_labels(spark, sf_dir),
                              S.mentions_from_conversations(spark, sf_dir))


REGISTRY = {
    "term_ranking_week": term_ranking("week"),
    "term_ranking_month": term_ranking("month"),
    "term_ranking_year": term_ranking("year"),
    "term_popularity_update": term_popularity_update,
    "top_terms": top_terms,
    "flavors_with_mentions": flavors_with_mentions,
    "product_metrics": product_metrics,
    "entity_metrics": entity_metrics,
    "score_stats": score_stats,
    "coverage_counts": coverage_counts,
}


# ------------------------------------------------------------ reports, filters, backlog
from brewlens.functions import text as T  # noqa: E402
from brewlens.functions import lexicons as LX  # noqa: E402
from brewlens.operators import quality as Q  # noqa: E402


def upper_median(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return Q.upper_median(o, "o_totalprice", "median_score")


def share_and_flags(spark, sf_dir):
    rep = Q.quality_report(S.posts_from_orders(spark, sf_dir))
    return rep.select("total", "total_comments", "min_score", "max_score",
                      F.round("avg_score", R).alias("avg_score"), "high_quality",
                      *[F.round(c, R).alias(c) for c in
                        ("high_quality_share", "with_text_share", "with_comments_share", "avg_comments")],
                      F.array_join("flags", ",").alias("flags"))


def array_len_totals(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    totals = c.agg(F.count_distinct("conv_id").alias("total_posts"),
                   F.count(F.lit(1)).alias("total_comments"),
                   F.sum(F.json_array_length(F.to_json(F.split("text", "\n")))).cast("long").alias("total_lines"))
    totals = totals.withColumn("avg_comments_per_post",
                               F.round(F.col("total_comments") / F.col("total_posts"), R))
    kept = Q.first_k_then_filter(c, "conv_id", "turn", LX.COMMENTS_FIRST_K, F.lit(True)) \
        .agg(F.count(F.lit(1)).alias("kept_first10"))
    return M.one_row(totals, kept)


def group_pct(spark, sf_dir):
    g = Q.group_share(S.table(spark, sf_dir, "documents"), "source")
    return g.select("source", "n", F.round("pct", R).alias("pct"), "total")


def date_span(spark, sf_dir):
    return Q.date_span(S.table(spark, sf_dir, "orders"), "o_orderdate")


def backlog_left_join(spark, sf_dir):
    return Q.backlog_counts(S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "labels"),
                            "doc_id", "doc_id")


def backlog_anti(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return Q.backlog(d, S.table(spark, sf_dir, "labels"), "doc_id", "doc_id")


def not_exists(spark, sf_dir):
    pr = (S.table(spark, sf_dir, "documents")
          .select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("post_id")))
    fe = S.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("processed_review_id"))
    return Q.backlog(pr, fe, "id", "processed_review_id")


def clean_text(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), T.clean_text("text").alias("cleaned"))
    p = MN.page_fields(S.table(spark, sf_dir, "pages")).select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        T.clean_text(F.concat_ws(" ", "url", "page_text")).alias("cleaned"))
    u = d.unionByName(p)
    return u.select("kind", "id", "cleaned", F.length("cleaned").cast("long").alias("n"))


def min_len(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"),
        T.post_text(F.lit(None).cast("string"), F.col("text")).alias("t"))
    p = MN.page_fields(S.table(spark, sf_dir, "pages")).select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        T.post_text(S.page_title(F.col("html")), F.col("page_text")).alias("t"))
    u = d.unionByName(p)
    return (u.where(F.length("t") >= LX.MIN_TEXT_CHARS)
            .select("kind", "id", F.length("t").cast("long").alias("n")))


def engagement_filter(spark, sf_dir):
    p = S.posts_from_orders(spark, sf_dir)
    return (p.where((F.col("score") >= LX.ENGAGEMENT_MIN_SCORE)
                    & (F.col("n_comments") >= LX.ENGAGEMENT_MIN_COMMENTS))
            .select("post_id", "score", "n_comments"))


def topic_filter(spark, sf_dir):
    p = S.posts_from_documents(spark, sf_dir)
    return (p.where(T.contains_any("title", LX.TOPIC_WORDS) & (F.col("score") >= LX.TOPIC_MIN_SCORE))
            .select("post_id", "title", "score"))


def first10_then_score(spark, sf_dir):
    # order lines as a post's comments: a part has about 30, so the first 10 are a real cut
    c = S.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("post_id"), "l_orderkey", "l_linenumber",
                                                  F.col("l_quantity").cast("long").alias("score"))
    return Q.first_k_then_filter(c, "post_id", ["l_orderkey", "l_linenumber"], LX.COMMENTS_FIRST_K,
                                 F.col("score") >= LX.COMMENT_MIN_SCORE)


CATALOG_WANTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                  "documents", "embeddings", "pages", "benchmark", "labels", "conversations", "raw_posts"]


def catalog_counts(spark, sf_dir):
    present = {}
    for name in CATALOG_WANTED:
        try:
            present[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        except AnalysisException as missing:        # any other error is an error
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    out = Q.catalog_counts(spark, present, CATALOG_WANTED)
    cols = {n: ",".join(df.columns) for n, df in present.items()}
    col_expr = F.coalesce(*[F.when(F.col("table_name") == n, F.lit(c)) for n, c in cols.items()], F.lit(None))
    return out.withColumn("columns", col_expr)


REGISTRY.update({
    "upper_median": upper_median,
    "share_and_flags": share_and_flags,
    "array_len_totals": array_len_totals,
    "group_pct": group_pct,
    "date_span": date_span,
    "backlog_left_join": backlog_left_join,
    "backlog_anti": backlog_anti,
    "not_exists": not_exists,
    "clean_text": clean_text,
    "min_len": min_len,
    "engagement_filter": engagement_filter,
    "topic_filter": topic_filter,
    "first10_then_score": first10_then_score,
    "catalog_counts": catalog_counts,
})


# ------------------------------------------------------------ extraction
from brewlens.operators import extract as X  # noqa: E402


def term_facts(spark, sf_dir, terms=LX.FLAVOR_TERMS):
    d = X.flavor_facts(S.cleaned_documents(spark, sf_dir).select("doc_id", "cleaned"), "cleaned", terms=terms)
    f = d.select("doc_id", F.explode_outer("flavors").alias("f")).where(F.col("f").isNotNull())
    return f.select("doc_id", F.col("f.ord").cast("long").alias("pos"), F.col("f.term").alias("term"),
                    F.col("f.intensity").alias("intensity"), F.col("f.confidence").alias("confidence"),
                    F.round("f.sentiment", R).alias("sentiment"), F.col("f.context").alias("context"),
                    F.col("f.is_primary").alias("is_primary"))


def term_facts_volume(spark, sf_dir):
    """term_facts with the test-volume fragments appended to the lexicon."""
    return term_facts(spark, sf_dir, LX.FLAVOR_TERMS + S.VOLUME_TERMS)


def brand_pattern(spark, sf_dir):
    r = X.roaster_facts(S.documents_and_parts(spark, sf_dir).select("doc_id", "text"), "text")
    return r.select("doc_id", F.posexplode_outer("roasters").alias("p", "r")).where(F.col("r").isNotNull()).select(
        "doc_id", (F.col("p") + 1).cast("long").alias("pos"), F.col("r.name").alias("name"),
        F.col("r.context").alias("context"))


def origin_norm(spark, sf_dir):
    d = S.documents_and_parts(spark, sf_dir).select("doc_id", T.clean_text("text").alias("cleaned"))
    d = X.origin_names(d, "cleaned", "canonical", "canonical")
    d = X.origin_names(d, "cleaned", "compat", "compat")
    kinds = [d.select("doc_id", F.lit(m).alias("mode"), F.posexplode_outer(m).alias("p", "origin"))
             .where(F.col("origin").isNotNull()) for m in ("canonical", "compat")]
    u = kinds[0].unionByName(kinds[1])
    return u.select("doc_id", "mode", (F.col("p") + 1).cast("long").alias("pos"), "origin")


LEXICON_KINDS = [("flavor", LX.FLAVOR_TERMS), ("brew", LX.BREW_METHODS), ("drink", LX.DRINK_TERMS),
                 ("roaster", LX.KNOWN_ROASTERS), ("origin", LX.ORIGIN_TERMS)]


def lexicon_hits(spark, sf_dir):
    d = (S.documents_and_parts(spark, sf_dir).select("doc_id", T.clean_text("text").alias("cleaned"))
         .select("doc_id", F.lower("cleaned").alias("lt")))
    def tag(kind):
        return lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"))
    parts = [F.transform(T.lexicon_hits(F.col("lt"), words, lowered=True), tag(kind))
             for kind, words in LEXICON_KINDS]
    e = d.select("doc_id", F.explode_outer(F.concat(*parts)).alias("h")).where(F.col("h").isNotNull())
    return e.select("doc_id", F.col("h.kind").alias("kind"), F.col("h.term").alias("term"))


def mention_freq(spark, sf_dir):
    posts = S.posts_from_documents(spark, sf_dir).select("post_id", "title", "body")
    m = X.drink_mentions(posts, S.comments_from_conversations(spark, sf_dir),
                         terms=LX.DRINK_TERMS + S.VOLUME_TERMS)
    counts = (m.select(F.explode_outer("mentioned_drinks").alias("term")).where(F.col("term").isNotNull())
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    n_posts = m.agg(F.count(F.lit(1)).alias("n_posts"))
    # the post count rides along as one extra row; windows over the small
    # aggregated table spread the totals (no join)
    u = counts.unionByName(n_posts, allowMissingColumns=True)
    all_rows = Window.partitionBy()
    j = u.select("term", "n", F.sum("n").over(all_rows).alias("total_mentions"),
                 F.count("term").over(all_rows).alias("unique_terms"),
                 F.max("n_posts").over(all_rows).alias("n_posts")).where(F.col("term").isNotNull())
    return j.select("term", "n", "total_mentions", "unique_terms", "n_posts",
                    F.round(F.col("total_mentions") / F.col("n_posts"), R).alias("avg_per_post"))


def first_price(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Paid $"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
                 F.lit(" or $ "), F.col("o_custkey").cast("string")).alias("t"))
    d = S.table(spark, sf_dir, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"),
                                                    F.col("text").alias("t"))
    u = o.unionByName(d)
    return u.select("kind", "id", T.first_price("t").alias("price"))


def keywords_topn(spark, sf_dir):
    return X.keywords(S.cleaned_documents(spark, sf_dir), "doc_id", "cleaned")


def word_count(spark, sf_dir):
    d = S.cleaned_documents(spark, sf_dir)
    return d.select("doc_id", T.word_count(F.lower("cleaned")).alias("word_count"))


REGISTRY.update({
    "term_facts": term_facts,
    "term_facts_volume": term_facts_volume,
    "brand_pattern": brand_pattern,
    "origin_norm": origin_norm,
    "lexicon_hits": lexicon_hits,
    "mention_freq": mention_freq,
    "first_price": first_price,
    "keywords_topn": keywords_topn,
    "word_count": word_count,
})


# ------------------------------------------------------------ keyed writes
from brewlens.operators import keyed as KT  # noqa: E402
from brewlens.operators import upsert as U  # noqa: E402


def union_dedupe_last(spark, sf_dir):
    e = S.table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    search = e.where(F.col("event_type").isin("click", "view")).select(
        "event_id", "value", F.lit("search").alias("src"), F.lit(0).alias("slice"), "ts")
    top = e.where(F.col("value") >= 250).select(
        "event_id", "value", F.lit("top").alias("src"), F.lit(1).alias("slice"), "ts")
    d = U.dedupe(search.unionByName(top), ["event_id"], ["slice", "ts"], keep="last")
    return d.select("event_id", "src", "value")


def _customer_rows(spark, sf_dir):
    return S.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), "c_acctbal")


def _insert_ignore_sides(spark, sf_dir):
    c = _customer_rows(spark, sf_dir)
    target = c.where(F.col("segment").isin("BUILDING", "AUTOMOBILE")).select(
        "id", "name", "segment", F.lit("T").alias("version"))
    first = c.where(F.col("c_acctbal") > 5000).select("id", "name", "segment", F.lit("A").alias("version"),
                                                      F.lit(0).alias("seq"))
    second = c.select("id", "name", "segment", F.lit("B").alias("version"), F.lit(1).alias("seq"))
    return target, first, second


def insert_ignore(spark, sf_dir):
    target, first, second = _insert_ignore_sides(spark, sf_dir)
    return U.insert_ignore(target, first.unionByName(second), ["id"], ["seq"])


def _upsert_sides(spark, sf_dir):
    """Stored rows of the customers with a balance, and an update for each customer with orders."""
    c = _customer_rows(spark, sf_dir)
    target = c.where(F.col("c_acctbal") >= 0).select(
        "id", F.col("name").alias("cleaned_text"), F.col("c_acctbal").alias("sentiment_score"),
        F.col("segment").alias("language"), F.lit(7).alias("word_count"),
        F.lit(None).cast("timestamp").alias("processed_at"))
    o = S.table(spark, sf_dir, "orders")
    upd = o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.concat(F.lit("orders "), F.count(F.lit(1)).cast("string")).alias("cleaned_text"),
        (F.max("o_totalprice") / 1e6).alias("sentiment_score"),
        F.lit("en").alias("language"),
        F.count(F.lit(1)).cast("int").alias("word_count"),
        F.lit(S.FIXED_NOW).cast("timestamp").alias("processed_at"))
    return target, upd, ["cleaned_text", "sentiment_score", "processed_at"]


def _upserted(m):
    return m.select("id", "cleaned_text", F.round("sentiment_score", R).alias("sentiment_score"), "language",
                    "word_count", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


def upsert_partial(spark, sf_dir):
    target, upd, changed = _upsert_sides(spark, sf_dir)
    return _upserted(U.upsert(target, upd, ["id"], changed))


def keyed_upsert(spark, sf_dir):
    """The same upsert written into a bucketed table, in two batches: first the orders of customers whose
    segment begins with a letter up to F, then all of them, so keys of the first come again."""
    target, upd, changed = _upsert_sides(spark, sf_dir)
    table = KT.KeyedTable.create(target, scratch_path(spark, "keyed-reviews"), ["id"], buckets=16)
    some = _customer_rows(spark, sf_dir).where(F.col("segment") < "G").select("id")
    table.upsert_into(upd.join(some, "id", "left_semi"), changed)
    table.upsert_into(upd, changed)
    return _upserted(table.read())


def keyed_insert_ignore(spark, sf_dir):
    """The same insert-ignore into a bucketed table; the second batch comes twice and adds nothing the second time."""
    target, first, second = _insert_ignore_sides(spark, sf_dir)
    table = KT.KeyedTable.create(target, scratch_path(spark, "keyed-posts"), ["id"], buckets=16)
    table.insert_ignore_into(first, ["seq"])
    table.insert_ignore_into(second, ["seq"])
    table.insert_ignore_into(second, ["seq"])
    return table.read()


def keyed_writeback(spark, sf_dir):
    """Array write-back into a bucketed table of orders, line by line item number."""
    orders, lines = _writeback_sides(spark, sf_dir)
    table = KT.KeyedTable.create(orders, scratch_path(spark, "keyed-orders"), ["id"], buckets=16)
    arrays = U.id_arrays(lines, "id", "l_partkey", "l_linenumber", "mentioned_flavor_ids")
    table.update_into(arrays, ["mentioned_flavor_ids"])
    return _written_back(table.read())


def rankings_upsert(spark, sf_dir):
    fe = S.flavor_mentions_from_events(spark, sf_dir)
    pr = S.reviews_from_customer(spark, sf_dir)
    stored = M.flavor_rankings(fe.where(F.col("created_at") < F.lit("2024-01-20 00:00:00").cast("timestamp")),
                               pr, "month", S.AS_OF).where(F.col("flavor_id") != "view")
    stored = stored.unionByName(M.flavor_rankings(fe, pr, "week", S.AS_OF))
    stored = stored.withColumn("computed_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    fresh = M.flavor_rankings(fe, pr, "month", S.AS_OF).withColumn(
        "computed_at", F.lit(S.FIXED_NOW).cast("timestamp"))
    r = M.upsert_rankings(stored, fresh)
    return r.select("flavor_id", _iso("period_start").alias("period_start"), "period_type", "mention_count",
                    "unique_products", F.round("avg_sentiment", 5).alias("avg_sentiment"),
                    "positive_mentions", "negative_mentions", "popularity_rank",
                    F.date_format("computed_at", "yyyy-MM-dd HH:mm:ss").alias("computed_at"))


def _writeback_sides(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                                 F.array().cast("array<bigint>").alias("mentioned_flavor_ids"))
    li = S.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_partkey", "l_linenumber")
    return o, li


def _written_back(w):
    return w.select("id", F.array_join(F.transform("mentioned_flavor_ids", lambda x: x.cast("string")), ",")
                    .alias("ids"))


def ids_writeback(spark, sf_dir):
    o, li = _writeback_sides(spark, sf_dir)
    return _written_back(U.ids_writeback(o, li, "id", "l_partkey", "l_linenumber", "mentioned_flavor_ids"))


REGISTRY.update({
    "union_dedupe_last": union_dedupe_last,
    "insert_ignore": insert_ignore,
    "upsert_partial": upsert_partial,
    "rankings_upsert": rankings_upsert,
    "ids_writeback": ids_writeback,
    "keyed_upsert": keyed_upsert,
    "keyed_insert_ignore": keyed_insert_ignore,
    "keyed_writeback": keyed_writeback,
})


# ------------------------------------------------------------ linking
from brewlens.operators import link as L  # noqa: E402
from brewlens.operators import nameindex as NI  # noqa: E402
from brewlens.session import checkpoint_root, merging  # noqa: E402


def alias_lookup(spark, sf_dir):
    aliases = L.flavor_alias_table(S.flavor_terms_from_part(spark, sf_dir))
    rows = L.link_flavors(S.flavor_facts_from_lineitem(spark, sf_dir), aliases)
    return rows.select("processed_review_id", "flavor_term_id", "mention_text", "mention_order")


def origin_key_lookup(spark, sf_dir):
    lookup, _ = L.find_or_create_origins(S.origins_from_nation(spark, sf_dir),
                                         S.origin_probes_from_customer(spark, sf_dir))
    return lookup.select("normalized_name",
                         F.when(F.col("created"), F.lit("new")).otherwise(F.col("origin_id").cast("string"))
                         .alias("origin_ref"), "country", F.coalesce("region", F.lit("")).alias("region"))


def fuzzy_best_match(spark, sf_dir):
    cache = L.entity_cache(S.entities_from_supplier(spark, sf_dir))
    probes = S.name_probes_from_customer(spark, sf_dir).withColumn("entity_type", F.lit("roaster"))
    m = L.match_entities(probes, cache)
    return m.select("probe_id", "entity_id", "method", F.round("ratio", R).alias("ratio"))


def entity_create_leaders(spark, sf_dir):
    return L.create_entities(S.name_probes_from_customer(spark, sf_dir), S.entities_from_supplier(spark, sf_dir))


def name_match_known(spark, sf_dir):
    """Exact and fuzzy matches of mentions whose entity is known by construction."""
    probes = S.known_probes_from_part(spark, sf_dir).withColumn("entity_type", F.lit("roaster"))
    m = L.match_entities(probes, L.entity_cache(S.known_names_from_part(spark, sf_dir)))
    return m.select("probe_id", "entity_id", "method", F.round("ratio", R).alias("ratio"))


def name_index_match(spark, sf_dir):
    """The same from a stored index that was filed in two parts."""
    cache = L.entity_cache(S.known_names_from_part(spark, sf_dir))
    later = F.col("pos_id") % 2 == 1
    index = NI.NameIndex.create(cache.where(~later), scratch_path(spark, "name-index"), buckets=16)
    index.add(cache.where(later))
    probes = S.known_probes_from_part(spark, sf_dir).withColumn("entity_type", F.lit("roaster"))
    return index.match(probes).select("probe_id", "entity_id", "method", F.round("ratio", R).alias("ratio"))


def name_create_known(spark, sf_dir):
    """Find-or-create where no entity exists: the first mention of a name creates it, the others follow."""
    none = S.known_names_from_part(spark, sf_dir).limit(0)
    made = L.create_entities(S.known_probes_from_part(spark, sf_dir, slugs=False), none)
    first = made.where(F.col("method") == "created").groupBy("entity_id").agg(F.min_by("name", "seq").alias("leader"))
    return made.join(first, "entity_id").select("probe_id", "method", T.slugify("leader").alias("slug"))


REGISTRY.update({
    "name_match_known": name_match_known,
    "name_index_match": name_index_match,
    "name_create_known": name_create_known,
    "alias_lookup": alias_lookup,
    "origin_key_lookup": origin_key_lookup,
    "fuzzy_best_match": fuzzy_best_match,
    "entity_create_leaders": entity_create_leaders,
})


# ------------------------------------------------------------ menus and pages
from brewlens.operators import menu as MN  # noqa: E402


def _menu_rows(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", S._pick(S.MENU_WORDS, F.col("p_partkey")))
    base = p.select(F.col("p_partkey").alias("item_id"), name.alias("name"),
                    F.col("p_type").alias("category"), F.col("p_brand").alias("description"),
                    F.concat_ws(" ", "p_type", "p_name", F.concat(F.col("p_size").cast("string"), F.lit(" calories")))
                    .alias("page_text"))
    a = MN.menu_items(base, "a").withColumn("source", F.lit("a"))
    b = MN.menu_items(base, "b").withColumn("source", F.lit("b"))
    return a.unionByName(b)


def menu_infer(spark, sf_dir):
    m = _menu_rows(spark, sf_dir)
    groups = (MN.customization_groups(spark).groupBy("source")
              .agg(F.array_join(F.sort_array(F.collect_list("group_name")), ",").alias("customization_groups")))
    j = m.join(F.broadcast(groups), "source", "left")
    return j.select("item_id", "source", "temperature", "has_caffeine", "is_seasonal",
                    F.array_join("sizes", ",").alias("sizes"), "customization_groups")


def calories(spark, sf_dir):
    m = _menu_rows(spark, sf_dir).where(F.col("source") == "a")
    return m.select("item_id", "calories")


def page_fields(spark, sf_dir):
    p = MN.page_fields(S.menu_pages(spark, sf_dir))
    return p.select("page_id", "name", "description", "meta_description",
                    F.array_join(MN.sizes(F.col("page_text"), "a"), ",").alias("sizes_a"),
                    F.array_join(MN.sizes(F.col("page_text"), "b"), ",").alias("sizes_b"),
                    F.length("page_text").cast("long").alias("text_chars"))


def page_links(spark, sf_dir):
    return MN.page_links(S.menu_pages(spark, sf_dir))


def readiness(spark, sf_dir):
    items = _menu_rows(spark, sf_dir).select("source")
    posts = S.table(spark, sf_dir, "documents").select("doc_id")
    return Q.readiness(items, posts)


REGISTRY.update({
    "menu_infer": menu_infer,
    "calories": calories,
    "page_fields": page_fields,
    "page_links": page_links,
    "readiness": readiness,
})


# ------------------------------------------------------------ composites


def _extracted_documents(spark, sf_dir, terms=LX.FLAVOR_TERMS):
    d = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"),
                                                   F.lit(None).cast("string").alias("title"),
                                                   F.col("text").alias("body"))
    return X.extract_posts(d, flavor_terms=terms)


def _posts(spark, sf_dir):
    """Every document and the part reviews as posts; the part reviews have negative ids."""
    return S.documents_and_parts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"))


def extract_all(spark, sf_dir):
    e = X.with_keywords(X.extract_posts(_posts(spark, sf_dir), flavor_terms=LX.FLAVOR_TERMS))
    return e.select(
        "id", F.round("sentiment_score", R).alias("sentiment_score"), "word_count",
        F.size("flavors").cast("long").alias("n_flavors"),
        F.array_join(F.transform(F.filter("flavors", lambda f: f["is_primary"]), lambda f: f["term"]), ",")
        .alias("primary_terms"),
        F.array_join(F.transform("roasters", lambda r: r["name"]), ",").alias("roasters"),
        F.array_join("origins", ",").alias("origins"),
        F.array_join("brew_methods", ",").alias("brew_methods"),
        "price",
        F.array_join("keywords", ",").alias("keywords"))


REGISTRY["extract_all"] = extract_all


# ------------------------------------------------------------ sources and streams
from brewlens.session import scratch_path  # noqa: E402
from brewlens.sources import ingest as IG  # noqa: E402
from brewlens.streaming import stream as ST  # noqa: E402


def _events_as_discussions(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("post_id"), F.col("event_type").alias("title"),
        F.col("props").alias("text"),
        F.when(F.col("user_id") > 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("author"),
        F.floor("value").alias("score"), F.lit(None).cast("double").alias("upvote_ratio"),
        F.lit(0).cast("long").alias("num_comments"), F.unix_seconds(F.col("ts").cast("timestamp"))
        .cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")).alias("url"),
        F.col("event_type").alias("subreddit"),
        F.array().cast(IG.DISCUSSION["top_comments"].dataType).alias("top_comments"),
        F.lit(None).cast("string").alias("flair"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("scraped_date"),
        F.array().cast("array<string>").alias("mentioned_drinks"))


def json_roundtrip(spark, sf_dir):
    """events -> landed JSON (by source and day) -> read back -> raw_posts."""
    path = scratch_path(spark, "landed-json")
    d = _events_as_discussions(spark, sf_dir).withColumn("source", F.col("subreddit")) \
        .withColumn("day", F.col("scraped_date"))
    IG.land_json(d, path, "source", "day")
    back = IG.read_json_records(spark, path)
    rp = IG.discussions_to_raw_posts(back, scraped_at=S.FIXED_NOW)
    return rp.select("id", "source", "title", "body", "url", "author",
                     F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss").alias("posted_at"))


def _land_events_for_stream(spark, sf_dir, landing):
    """Land the events as JSON files, plus a replay of one event type (dupes)."""
    e = S.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("term"),
        F.col("user_id").cast("string").alias("post_id"), F.col("ts").cast("timestamp").alias("created_at"),
        (F.col("value") / 250.0 - 1.0).alias("sentiment"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("confidence"))
    e.write.mode("overwrite").option("timestampFormat", IG.TS_FORMAT).json(f"{landing}/a")
    (e.where(F.col("term") == "click").write.mode("overwrite")
     .option("timestampFormat", IG.TS_FORMAT).json(f"{landing}/b"))
    return e.schema


STREAM_SCHEMA = "id string, post_id string, created_at timestamp, sentiment double, confidence double, term string"


def stream_ingest_equals_batch(spark, sf_dir):
    land = scratch_path(spark, "landing")
    _land_events_for_stream(spark, sf_dir, land)
    target, ckpt = scratch_path(spark, "raw-events"), scratch_path(spark, "ckpt-ingest")
    schema = _ddl(STREAM_SCHEMA)
    ST.ingest(spark, f"{land}/*", schema, ["id"], target, ckpt, max_files_per_trigger=2)
    t = spark.read.parquet(target)
    return t.select("id", "term", "post_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"))


def _ddl(s):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(s)


def _stream_partials(spark, sf_dir, prepared=lambda events: events):
    """Land the events, run the two daily streams to completion.  Returns the daily
    partials with the open days added, and the first (day, term, post) rows."""
    land = scratch_path(spark, "landing")
    _land_events_for_stream(spark, sf_dir, land)
    reader = {"schema": _ddl(STREAM_SCHEMA), "timestampFormat": IG.TS_FORMAT}
    parts, c1 = scratch_path(spark, "daily-partials"), scratch_path(spark, "ckpt-partials")
    firsts, c2 = scratch_path(spark, "daily-firsts"), scratch_path(spark, "ckpt-firsts")
    src = prepared(spark.readStream.schema(reader["schema"]).option("timestampFormat", IG.TS_FORMAT).json(f"{land}/a"))
    ST.write_append(ST.daily_partials(src), parts, c1)
    ST.write_append(ST.daily_distinct(src), firsts, c2)
    landed = prepared(spark.read.schema(reader["schema"]).option("timestampFormat", IG.TS_FORMAT).json(f"{land}/a"))
    return ST.with_open_days(spark.read.parquet(parts), landed), spark.read.parquet(firsts)


def stream_rollup(spark, sf_dir):
    """7/30/365-day figures per term from the daily partials: the batch rankings' figures."""
    reviews = S.reviews_from_customer(spark, sf_dir).select(F.col("id").cast("string").alias("_id"), F.col("post_id").alias("_post"))

    def prepared(events):
        kept = events.where(F.col("confidence") > LX.RANKING_MIN_CONFIDENCE)
        return kept.join(reviews, F.col("post_id") == F.col("_id")).drop("post_id", "_id").withColumnRenamed("_post", "post_id")

    p, firsts = _stream_partials(spark, sf_dir, prepared)
    out = None
    for period in ("week", "month", "year"):
        days = M.period_days(period)
        start = F.lit(S.AS_OF).cast("date") - F.expr(f"INTERVAL {days} DAYS")
        posts = firsts.where(F.col("day") >= start).groupBy("term").agg(F.count_distinct("post_id").alias("unique_products"))
        r = ST.rollup_partials(p, S.AS_OF, days).join(posts, "term").withColumn("period_type", F.lit(period))
        out = r if out is None else out.unionByName(r)
    return out.select("period_type", "term", F.col("mention_count").cast("long").alias("mention_count"), "unique_products",
                      F.round("avg_sentiment", 5).alias("avg_sentiment"),
                      F.col("positive_mentions").cast("long").alias("positive_mentions"),
                      F.col("negative_mentions").cast("long").alias("negative_mentions"))


def stream_windows(spark, sf_dir):
    p, firsts = _stream_partials(spark, sf_dir)
    u = firsts.groupBy("day", "term").agg(F.count(F.lit(1)).alias("unique_posts"))
    j = p.withColumn("day", F.to_date("window_start")).join(u, ["day", "term"], "left")
    return j.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "term", "mention_count",
                    F.round("sentiment_sum", R).alias("sentiment_sum"), "positive_mentions", "negative_mentions",
                    F.coalesce("unique_posts", F.lit(0)).cast("long").alias("unique_posts"))


POST_SCHEMA = "id long, title string, body string"


def stream_extract(spark, sf_dir):
    """Posts land as JSON files; each micro-batch of new posts is extracted
    and appended (insert-ignore on id).  Equals the batch extraction."""
    land = scratch_path(spark, "landing-posts")
    _posts(spark, sf_dir).write.mode("overwrite").json(f"{land}/a")
    target, ckpt = scratch_path(spark, "processed"), scratch_path(spark, "ckpt-extract")

    def extract(batch):
        e = X.extract_posts(batch)
        return e.select("id", "sentiment_score", "word_count", F.size("flavors").cast("long").alias("n_flavors"),
                        "price")

    ST.ingest(spark, f"{land}/*", _ddl(POST_SCHEMA), ["id"], target, ckpt, max_files_per_trigger=16,
              transform=extract, buckets=16)
    t = spark.read.parquet(target)
    return t.select("id", F.round("sentiment_score", R).alias("sentiment_score"), "word_count", "n_flavors", "price")


REGISTRY.update({
    "stream_extract": stream_extract,
    "json_roundtrip": json_roundtrip,
    "stream_ingest_equals_batch": stream_ingest_equals_batch,
    "stream_windows": stream_windows,
    "stream_rollup": stream_rollup,
})


def menu_links(spark, sf_dir):
    m = MN.menu_links(S.menu_pages(spark, sf_dir))
    return m.select("page_id", F.array_join("product_links", ",").alias("product_links"),
                    F.array_join("item_links", ",").alias("item_links"),
                    F.array_join(F.transform("categories", lambda c: F.concat_ws("=", c["path"], c["name"])), ",")
                    .alias("categories"))


REGISTRY["menu_links"] = menu_links


from brewlens.operators import containment as CT  # noqa: E402


def lexicon_table_hits(spark, sf_dir):
    """Whole-word hits of a lexicon table derived from the benchmark passages:
    all their words, word pairs, three- and four-word runs."""
    b = S.table(spark, sf_dir, "benchmark").select(X.words_of(F.col("text")).alias("w"))
    lexicon = b.select(F.explode_outer(X.word_ngrams(F.col("w"), 4)).alias("term")).where(F.col("term").isNotNull())
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    return X.lexicon_join(docs, "doc_id", "text", lexicon)


REGISTRY["lexicon_table_hits"] = lexicon_table_hits


def substring_table_hits(spark, sf_dir):
    """Substring hits of all four-word runs of the benchmark passages, as they stand there."""
    w = S.table(spark, sf_dir, "benchmark").select(F.split("text", " ").alias("w"))
    runs = F.expr("transform(sequence(1, greatest(size(w) - 3, 0)), i -> array_join(slice(w, i, 4), ' '))")
    lexicon = w.select(F.explode_outer(F.when(F.size("w") >= 4, runs)).alias("term")).where(F.col("term").isNotNull())
    return CT.substring_join(S.table(spark, sf_dir, "documents"), "doc_id", "text", lexicon)


REGISTRY["substring_table_hits"] = substring_table_hits


def extractions_upsert(spark, sf_dir):
    """Stored extractions re-extracted with a wider lexicon: flavors, roasters,
    origins, brew methods and price are replaced; process_methods keeps the
    stored value (it is not in the update list)."""
    posts = _posts(spark, sf_dir)
    stored = X.extract_posts(posts, flavor_terms=LX.FLAVOR_TERMS).withColumn("process_methods", F.array(F.lit("washed")))
    fresh = X.extract_posts(posts, flavor_terms=LX.FLAVOR_TERMS + S.VOLUME_TERMS)
    cols = ["id", "flavors", "roasters", "origins", "brew_methods", "process_methods", "price"]
    m = U.upsert(stored.select(*cols), fresh.select(*cols), ["id"],
                 ["flavors", "roasters", "origins", "brew_methods", "price"])
    return m.select("id", F.size("flavors").cast("long").alias("n_flavors"),
                    F.array_join("process_methods", ",").alias("process_methods"), "price")


REGISTRY["extractions_upsert"] = extractions_upsert


# ------------------------------------------------------------ the tables that linking writes
from brewlens.operators.linkstore import LinkStore  # noqa: E402


def _to_link(posts):
    """Extractions of posts, as linking takes them."""
    e = X.extract_posts(posts, flavor_terms=LX.FLAVOR_TERMS)
    return e.select(F.col("id").alias("processed_review_id"), F.col("id").cast("string").alias("post_id"), "flavors", "roasters",
                    "origins")


def _flavor_dimension(spark):
    return spark.createDataFrame([(i + 1, t, t, []) for i, t in enumerate(LX.FLAVOR_TERMS)],
                                 "id long, term string, normalized_term string, synonyms array<string>")


def _new_store(spark, sf_dir):
    entities = S.entities_from_supplier(spark, sf_dir).withColumn("verified", F.lit(True))
    return LinkStore.create(spark, scratch_path(spark, "link-store"),
                            {"entities": entities, "origins": S.origins_from_nation(spark, sf_dir)}, buckets=8)


_STORES: dict = {}


def _link_store(spark, sf_dir):
    """The store of a table folder, linked once per application from stored extractions: first the part
    reviews, then everything, which meets a filled ledger and the mentions of the first run."""
    key = (spark.sparkContext.applicationId, checkpoint_root(spark), sf_dir)
    if key not in _STORES:
        stored = scratch_path(spark, "extractions")
        _to_link(_posts(spark, sf_dir)).write.parquet(stored)
        extractions, store = spark.read.parquet(stored), _new_store(spark, sf_dir)
        for run, batch in (("parts", extractions.where(F.col("processed_review_id") < 0)), ("all", extractions)):
            store.link(batch, _flavor_dimension(spark), run, LX.CONTEXT_CHARS)
        _STORES[key] = store.path
    return LinkStore(spark, _STORES[key])


def _mentions(store):
    named = store.read("entities").select(F.col("id").alias("roaster_id"), "slug")
    return store.read("coffee_mentions").join(merging(named), "roaster_id").select(
        "post_id", "slug", "mention_text", "mention_context", "confidence_score")


def link_mentions(spark, sf_dir):
    """coffee_mentions rows; the entity is named by its slug."""
    return _mentions(_link_store(spark, sf_dir))


def link_reviews(spark, sf_dir):
    """The three arrays on each review: flavor ids, entity slugs, and the origins by their keys."""
    store = _link_store(spark, sf_dir)
    reviews = store.read("reviews")

    def named(column, ids, names, name):
        # the array's ids replaced by what the dimension calls them, in order
        flat = reviews.select("id", F.posexplode(column).alias("pos", ids)).join(merging(names), ids)
        return flat.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", name))), lambda x: x[name]).alias(column))

    slugs = named("mentioned_roaster_ids", "entity_id", store.read("entities").select(F.col("id").alias("entity_id"), "slug"), "slug")
    origins = named("mentioned_origins", "origin_id",
                    store.read("origins").select(F.col("id").cast("string").alias("origin_id"), "normalized_name"), "normalized_name")
    out = reviews.select("id", "mentioned_flavor_ids", F.size("mentioned_origins").cast("long").alias("n_origins")) \
        .join(merging(slugs), "id", "left").join(merging(origins), "id", "left")
    return out.select("id", F.array_join(F.transform("mentioned_flavor_ids", lambda x: x.cast("string")), ",").alias("flavor_ids"),
                      F.coalesce(F.array_join("mentioned_roaster_ids", ","), F.lit("")).alias("roasters"), "n_origins",
                      F.coalesce(F.array_join(F.array_sort("mentioned_origins"), ","), F.lit("")).alias("origins"))


def link_dimensions(spark, sf_dir):
    """Entities and origins after linking, as one table of names."""
    store = _link_store(spark, sf_dir)
    e = store.read("entities").select(F.lit("entity").alias("kind"), "name", F.col("slug").alias("key"),
                                      F.when(F.col("verified"), "known").otherwise("new").alias("state"))
    o = store.read("origins").select(F.lit("origin").alias("kind"), F.col("country").alias("name"),
                                     F.col("normalized_name").alias("key"), F.lit("").alias("state"))
    return e.unionByName(o)


def link_all(spark, sf_dir):
    """Links per review: flavors, roasters, origins."""
    sizes = {"flavors_linked": "mentioned_flavor_ids", "roasters_linked": "mentioned_roaster_ids",
             "origins_linked": "mentioned_origins"}
    return _link_store(spark, sf_dir).read("reviews").select(
        "id", *[F.size(c).cast("long").alias(n) for n, c in sizes.items()])


def link_stats(spark, sf_dir):
    """Statistics observed while the runs were written, summed over them."""
    names = ["flavors_linked", "roasters_linked", "origins_linked", "products_linked", "reviews_with_flavors",
             "reviews_with_roasters", "reviews_linked", "entities_created", "origins_created"]
    return _link_store(spark, sf_dir).run_statistics().agg(*[F.sum(n).alias(n) for n in names])


def link_backlog(spark, sf_dir):
    """Reviews still to link after the run over the part reviews alone: the ledger is filled, the documents open."""
    store = _link_store(spark, sf_dir)
    first = store.spark.read.parquet(f"{store.path}/runs/parts/linked_ids").select("processed_review_id")
    open_ids = Q.backlog(store.read("reviews").select("id"), merging(first.select(F.col("processed_review_id").alias("id"))), "id", "id")
    return open_ids.select("id")


def stream_link(spark, sf_dir):
    """Posts land as JSON files, the part reviews first; each micro-batch is extracted and linked into the
    stored tables.  The last batch is then replayed by its id, which changes nothing."""
    land, ckpt, store = scratch_path(spark, "landing-link"), scratch_path(spark, "ckpt-link"), _new_store(spark, sf_dir)
    posts = _posts(spark, sf_dir)
    for part, some in (("a", posts.where("id < 0")), ("b", posts.where("id >= 0"))):
        some.write.json(f"{land}/{part}")
        ST.link_stream(spark, f"{land}/*", _ddl(POST_SCHEMA), store.path, _to_link, _flavor_dimension(spark), ckpt,
                       LX.CONTEXT_CHARS)
    store.link(_to_link(posts), _flavor_dimension(spark), "batch-1", LX.CONTEXT_CHARS)
    return _mentions(store)


REGISTRY.update({"link_mentions": link_mentions, "link_reviews": link_reviews, "link_dimensions": link_dimensions,
                 "link_all": link_all, "link_stats": link_stats, "link_backlog": link_backlog, "stream_link": stream_link})


def processed_reviews(spark, sf_dir):
    """The row that extraction stores for each post."""
    e = X.processed_reviews(_extracted_documents(spark, sf_dir), S.FIXED_NOW)
    return e.select("post_id", "cleaned_text", F.round("sentiment_score", R).alias("sentiment_score"), "language", "word_count",
                    F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


def menu_records(spark, sf_dir):
    """Menu items with their option and nutrition maps, as sorted text."""
    m = _menu_rows(spark, sf_dir)
    options = F.transform(F.array_sort(F.map_keys("customizations")),
                          lambda k: F.concat(k, F.lit("="), F.array_join(F.element_at("customizations", k), "|")))
    facts = F.transform(F.map_keys("nutrition"), lambda k: F.concat(k, F.lit("="), F.element_at("nutrition", k)))
    return m.select("item_id", "source", "name", F.array_join(options, ";").alias("customizations"),
                    F.array_join(facts, ";").alias("nutrition"))


REGISTRY.update({"processed_reviews": processed_reviews, "menu_records": menu_records})


def sentiment_table(spark, sf_dir):
    """Sentiment from a lexicon table: every word of the benchmark passages, its polarity by a rule on its letters."""
    words = S.table(spark, sf_dir, "benchmark").select(F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit("[a-z']+"), 0)).alias("word"))
    words = words.where(F.col("word").isNotNull()).distinct()
    lexicon = words.select("word", (((F.length("word") + F.ascii("word")) % 5 - 2) / 2.0).alias("polarity"))
    scored = X.sentiment_join(S.table(spark, sf_dir, "documents"), "doc_id", "text", lexicon, negators=["the", "on"])
    return scored.select("doc_id", F.round("sentiment", 12).alias("sentiment"))     # halves of small powers of two: no ties this far out


INVENTORY = ["benchmark", "conversations", "customer", "labels", "nation", "part", "region", "supplier"]


def catalog_inventory(spark, sf_dir):
    """The given tables as views in the catalog, listed from there, and one name that is not there."""
    for name in INVENTORY:
        S.table(spark, sf_dir, name).createOrReplaceTempView(f"given_{name}")
    return Q.inventory(spark, [f"given_{name}" for name in INVENTORY] + ["given_nothing"])


REGISTRY.update({"sentiment_table": sentiment_table, "catalog_inventory": catalog_inventory})


def stream_late(spark, sf_dir):
    """Daily figures from a stream whose every seventh event lands only after all the others: those of the days
    before are late and are added to their days."""
    path, land, ckpt = (scratch_path(spark, n) for n in ("late-partials", "landing-late", "ckpt-late"))
    e = S.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("term"), F.col("ts").cast("timestamp").alias("created_at"),
        (F.col("value") / 250.0 - 1.0).alias("sentiment"))
    for part, some in (("a", e.where("event_id % 7 <> 0")), ("b", e.where("event_id % 7 = 0"))):
        some.write.option("timestampFormat", IG.TS_FORMAT).json(f"{land}/{part}")
        src = spark.readStream.schema(_ddl("event_id long, term string, created_at timestamp, sentiment double")) \
            .option("timestampFormat", IG.TS_FORMAT).json(f"{land}/*")
        ST.merge_partials(src, path, ckpt)
    t = ST.open_partials(spark, path).read()
    return t.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "term", "mention_count",
                    F.round("sentiment_sum", R).alias("sentiment_sum"), "positive_mentions", "negative_mentions", "late_mentions")


REGISTRY["stream_late"] = stream_late


def menu_json_links(spark, sf_dir):
    """Links of pages that keep them in a JSON state or fetch them as JSON."""
    pages, bodies = S.scripted_pages(spark, sf_dir)
    m = MN.menu_links(pages, bodies=bodies)
    return m.select("page_id", F.array_join("product_links", ",").alias("product_links"), F.array_join("item_links", ",").alias("item_links"))


REGISTRY["menu_json_links"] = menu_json_links
