"""Driver tables mapped onto the domain schemas.

Each function reads the given parquet tables and renames/derives columns so
the generic operators run unchanged; ``brewlens.plans.oracles`` holds the same
mappings as DuckDB CTEs.  Only the columns an operator needs are selected, so
the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-05"          # the test tables' events run 1-30 January 2024
FIXED_NOW = "2024-02-05 00:00:00"


TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_TABLES:
        from brewlens.session import spread
        df = spread(df)
    return df


# ------------------------------------------------------------ events as mentions

def flavor_mentions_from_events(spark, sf_dir) -> DataFrame:
    """events -> flavor_extractions: term = event_type, review = user_id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("processed_review_id"),
        F.col("user_id").cast("string").alias("post_id"),
        F.col("event_type").alias("flavor_term_id"),
        F.col("ts").alias("created_at"),  # TIMESTAMP_NTZ, read as UTC wall time
        (F.col("value") / 250.0 - 1.0).alias("sentiment"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("confidence_score"))


def reviews_from_customer(spark, sf_dir) -> DataFrame:
    """customer -> processed_reviews (id, post_id = nation key as text)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("post_id"))


def reviews_from_events(spark, sf_dir) -> DataFrame:
    """events -> processed_reviews with a sentiment score (value/250 - 1)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"),
                    (F.col("value") / 250.0 - 1.0).alias("sentiment_score"),
                    F.col("value").alias("score"))


# ------------------------------------------------------------ part / lineitem

def flavor_terms_from_part(spark, sf_dir) -> DataFrame:
    """part -> flavor_terms; the stored total_mentions is p_size (stale value)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("term"),
        F.lower("p_brand").alias("normalized_term"),
        F.split("p_name", " ").alias("synonyms"),
        F.col("p_size").cast("long").alias("total_mentions"))


def flavor_extractions_from_lineitem(spark, sf_dir) -> DataFrame:
    """lineitem -> flavor_extractions; confidence = 1 - 10 * discount."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("flavor_term_id"),
                     (F.lit(1.0) - F.col("l_discount") * 10.0).alias("confidence_score"))


def brand_id(c):
    return F.substring_index(c, "#", -1).cast("long")


def products_from_part(spark, sf_dir) -> DataFrame:
    """part -> coffee_products; entity = the part's brand; stale metric values."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        brand_id(F.col("p_brand")).alias("entity_id"),
        F.lit(0).cast("long").alias("total_ratings"),
        (F.col("p_retailprice") / 100.0).alias("avg_rating"),
        F.lit(0).cast("long").alias("total_reviews"),
        F.col("p_size").cast("long").alias("mention_count"),
        F.lit(None).cast("timestamp").alias("updated_at"))


def product_reviews_from_lineitem(spark, sf_dir) -> DataFrame:
    """lineitem -> product_reviews; rating = quantity / 10, null for N/O lines."""
    li = table(spark, sf_dir, "lineitem")
    rating = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None)) \
        .otherwise(F.col("l_quantity") / 10.0)
    return li.select(F.col("l_partkey").alias("product_id"), rating.cast("double").alias("overall_rating"))


def mentions_from_lineitem(spark, sf_dir) -> DataFrame:
    """lineitem -> coffee_mentions: post = order, roaster = the part's brand,
    product linked only on returned lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("l_orderkey").cast("string").alias("post_id"),
        brand_id(F.col("p_brand")).alias("roaster_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("coffee_product_id"))


def entities_from_part(spark, sf_dir) -> DataFrame:
    """Distinct brands of part -> entities with zeroed metrics."""
    p = table(spark, sf_dir, "part")
    return (p.select(brand_id(F.col("p_brand")).alias("id"), F.col("p_brand").alias("name"))
            .distinct()
            .select("id", "name",
                    F.lit(0).cast("long").alias("product_count"),
                    F.lit(0.0).alias("avg_product_rating"),
                    F.lit(0).cast("long").alias("total_reviews"),
                    F.lit(None).cast("timestamp").alias("updated_at")))


# ------------------------------------------------------------ documents

def reviews_from_documents(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("post_id"))


def extractions_from_labels(spark, sf_dir) -> DataFrame:
    lb = table(spark, sf_dir, "labels")
    return lb.select(F.col("doc_id").alias("processed_review_id"))


def mentions_from_conversations(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("post_id"))


# ------------------------------------------------------------ posts for reports

def posts_from_orders(spark, sf_dir) -> DataFrame:
    """orders -> scored posts: score = totalprice / 1000 (whole), comments =
    the order's line items, text = the document with the same id (if any)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n_comments")))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = (o.join(li, o.o_orderkey == li.l_orderkey, "left")
         .join(d, o.o_orderkey == d.doc_id, "left"))
    return j.select(F.col("o_orderkey").alias("post_id"),
                    F.floor(F.col("o_totalprice") / 1000.0).cast("long").alias("score"),
                    F.col("text"),
                    F.coalesce("n_comments", F.lit(0)).cast("long").alias("n_comments"))


def page_title(html_col):
    return F.regexp_extract(html_col, r"<title>(.*?)</title>", 1)


def posts_from_documents(spark, sf_dir) -> DataFrame:
    """documents -> posts: title = first line, score = n_chars / 100 (whole)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("post_id"),
                    F.substring_index("text", "\n", 1).alias("title"),
                    F.col("text").alias("body"),
                    F.floor(F.col("n_chars") / 100.0).cast("long").alias("score"))


# Test-only extra lexicon entries: the driver's synthetic prose contains none
# of the drink words, so mention counting gets common fragments for volume.
VOLUME_TERMS = ["the", "tion", "ble"]


def comments_from_conversations(spark, sf_dir) -> DataFrame:
    """conversations -> comments(post_id, seq, body, score = length / 100)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("post_id"), F.col("turn").alias("seq"), F.col("text").alias("body"),
                    F.floor(F.length("text") / 100.0).cast("long").alias("score"))


def cleaned_documents(spark, sf_dir) -> DataFrame:
    from brewlens.functions.text import clean_text
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", "text", clean_text("text").alias("cleaned"))


# ------------------------------------------------------------ linking

def entities_from_supplier(spark, sf_dir) -> DataFrame:
    """supplier -> entities; type 'roaster' for a non-negative balance, else 'cafe'."""
    from brewlens.functions.text import slugify
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    slugify(F.col("s_name")).alias("slug"),
                    F.when(F.col("s_acctbal") >= 0, F.lit("roaster")).otherwise(F.lit("cafe")).alias("entity_type"))


def _invented_name(seed):
    """Two words of nine letters each, spelled from the md5 of a text: names that resemble no other."""
    letters = F.translate(F.md5(seed.cast("binary")), "0123456789", "ghijklmnop")
    return F.concat(F.substring(letters, 1, 9), F.lit(" "), F.substring(letters, 10, 9))


def known_names_from_part(spark, sf_dir) -> DataFrame:
    """An entity for every third part, under an invented name."""
    from brewlens.functions.text import slugify
    p = table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 == 0)
    name = F.initcap(_invented_name(F.concat("p_name", F.col("p_partkey").cast("string"))))
    return p.select(F.col("p_partkey").alias("id"), name.alias("name"), slugify(name).alias("slug"),
                    F.lit("roaster").alias("entity_type"))


def known_probes_from_part(spark, sf_dir, slugs: bool = True) -> DataFrame:
    """A mention of every part's entity (that of the last third key): the whole name in capitals, the name less
    one letter, and the slug or, for odd keys, a name nobody has.  Without ``slugs`` the third is again a
    name less a letter."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    base = p.where(k % 3 == 0).select(k.alias("base"), F.initcap(_invented_name(F.concat("p_name", k.cast("string")))).alias("whole"))
    at = k % 15 + 2
    less = F.concat(F.substr("whole", F.lit(1), at - 1), F.substr("whole", at + 1))
    from brewlens.functions.text import slugify
    from brewlens.session import merging
    third = F.when(k % 2 == 0, slugify(F.col("whole"))).otherwise(_invented_name(F.concat(F.lit("x"), k.cast("string"))))
    padded = F.concat(F.lit("  "), F.upper("whole"), F.lit(" ")) if slugs else F.upper("whole")
    name = (F.when(k % 3 == 0, padded).when((k % 3 == 1) | F.lit(not slugs), less)
            .otherwise(third))
    return p.select(k, (k - k % 3).alias("base")).join(merging(base), "base").select(
        k.alias("probe_id"), k.alias("seq"), name.alias("name"))


def name_probes_from_customer(spark, sf_dir) -> DataFrame:
    """customer names respelled as supplier names with one character dropped
    (the second to last), in customer-key order: near matches and near
    duplicates of each other."""
    c = table(spark, sf_dir, "customer")
    n = F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Supplier"))
    edited = F.concat(F.substring(n, F.lit(1), F.length(n) - 2), F.substring(n, F.length(n), F.lit(1)))
    return c.select(F.col("c_custkey").alias("probe_id"), F.col("c_custkey").alias("seq"), edited.alias("name"))


def flavor_facts_from_lineitem(spark, sf_dir) -> DataFrame:
    """lineitem x part -> flavor facts of a review (= order): the mention is the
    part name in upper case with padding, or its last word for returned lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    term = F.when(F.col("l_returnflag") == "R", F.substring_index("p_name", " ", -1)) \
        .otherwise(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")))
    return j.select(F.col("l_orderkey").alias("processed_review_id"),
                    F.col("l_orderkey").cast("string").alias("post_id"),
                    term.alias("term"), F.lit(None).cast("string").alias("context"),
                    F.lit(None).cast("string").alias("intensity"), F.lit(None).cast("double").alias("sentiment"),
                    F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("boolean").alias("is_primary"),
                    (F.col("l_linenumber") - 1).alias("pos"))


def origins_from_nation(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("country"),
                    F.col("r_name").alias("region"),
                    F.concat(F.lower("n_name"), F.lit("_"), F.lower("r_name")).alias("normalized_name"))


def origin_probes_from_customer(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("n_name").alias("country"),
                    F.when(F.col("c_mktsegment") == "BUILDING", F.col("r_name")).alias("region"))


# ------------------------------------------------------------ texts with hits, from part rows

def _pick(words, key):
    """The word of a fixed list that a key falls on."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(key, F.lit(len(words))) + 1).cast("int"))


def documents_and_parts(spark, sf_dir) -> DataFrame:
    """doc_id, lang, text of every document, and of a review made of every part
    row (doc_id = -1 - p_partkey): brand, origin, brew method, flavor, drink, price."""
    from brewlens.functions import lexicons as LX
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = F.concat(F.initcap("p_name"), F.lit(" Coffee was prominent. "), _pick(LX.FLAVOR_TERMS, k), F.lit(" notes from "),
                    _pick(LX.ORIGIN_TERMS, k), F.lit(", "), _pick(LX.BREW_METHODS, k), F.lit(" at "),
                    _pick(LX.KNOWN_ROASTERS, F.col("p_size")), F.lit(". "), _pick(LX.DRINK_TERMS, k), F.lit("! Paid $"),
                    F.col("p_size").cast("string"), F.lit(".50."))
    return d.unionByName(p.select((-1 - k).cast("long").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text")))


MENU_WORDS = ["decaf", "herbal tea", "pumpkin", "frappuccino", "black tea", "iced", "frozen", "peppermint"]


def menu_pages(spark, sf_dir) -> DataFrame:
    """The pages, and a menu page made of every part row (page_id = -1 - p_partkey)."""
    g = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    kind = F.pmod(F.col("p_partkey"), F.lit(3))
    slug = F.replace("p_name", F.lit(" "), F.lit("-"))
    meta = F.when(kind == 0, F.concat(F.lit("<meta content='"), "p_name", F.lit("' name='description'>"))) \
        .otherwise(F.concat(F.lit('<meta name="description" content=" '), "p_name", F.lit('">')))
    anchors = F.concat(
        F.lit('<link href="/style.css"><a class="x" href="/menu/product/'), k, F.lit('">'), F.col("p_name"),
        F.lit('</a><a href="https://shop.example.com/en/menu/'), F.lower("p_type"), F.lit("/"), slug,
        F.lit('?x=1">item</a><a href="/en/menu/'), F.lower("p_type"), F.lit('"><b>'), F.col("p_type"),
        F.lit("</b></a><a href='/en/menu/"), slug, F.lit("'></a>"))
    script = F.concat(F.lit('<script>var a="/menu/product/s-'), k, F.lit('", b="/en/menu/'), F.lower("p_type"), F.lit("/"),
                      slug, F.lit('";</script>'))
    html = F.concat(F.lit("<html><head>"), meta, F.lit("</head><body><h1>"), F.col("p_name"), F.lit("</h1>"),
                    F.when(kind == 2, script).otherwise(anchors), F.lit("</body></html>"))
    return g.unionByName(p.select((-1 - F.col("p_partkey")).cast("long").alias("page_id"),
                                  F.lit("https://shop.example.com/en/menu").alias("url"), html.alias("html")))


def scripted_pages(spark, sf_dir):
    """The pages, and a page of every part row (page_id = -1 - p_partkey) whose links stand in no anchor: every
    third in a JSON state with escaped slashes, every third in a captured body only, every third nowhere.
    Returns the pages and the captured bodies."""
    g = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    p = table(spark, sf_dir, "part")
    k, kind = F.col("p_partkey").cast("string"), F.pmod(F.col("p_partkey"), F.lit(3))
    page_id = (-1 - F.col("p_partkey")).alias("page_id")
    state = F.concat(F.lit('<script>window.__PRELOADED_STATE__ = {"menu":{"items":[{"name":"'), F.col("p_name"),
                     F.lit('","uri":"\\/menu\\/product\\/s-'), k, F.lit('"}]}};</script>'))
    html = F.concat(F.lit("<html><head>"), F.when(kind == 0, state).otherwise(F.lit("")),
                    F.lit('</head><body><a href="/about">about</a></body></html>'))
    made = p.select(page_id, F.lit("https://shop.example.com/menu").alias("url"), html.alias("html"))
    body = F.concat(F.lit('{"data":[{"url":"/menu/product/b-'), k, F.lit('"},{"url":"/en/menu/'), F.lower("p_type"), F.lit("/x-"), k, F.lit('"}]}'))
    bodies = p.where(kind == 1).select(page_id, F.lit("application/json; charset=utf-8").alias("mime_type"), body.alias("body"))
    other = p.select(page_id, F.lit("text/css").alias("mime_type"), F.lit('"/menu/product/never"').alias("body"))
    return g.unionByName(made), bodies.unionByName(other)
