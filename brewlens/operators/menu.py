"""Menu items and web pages: attribute inference, page fields and links.

Pages are rows of (page_id, url, html); every field is a regex/array
expression over the row, so a crawl of any size is a narrow map.  HTML text
rule (ours, defined so it is reproducible in SQL): drop comments, scripts and
styles; a paragraph runs from ``<p ...>`` to the next ``</p>`` or ``<p``;
tags become spaces; a fixed set of entities is decoded; whitespace collapses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX
from brewlens.functions import text as T

# FIXED VALUES: HTML entities decoded in page text
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

COMMENTS = r"(?s)<!--.*?-->"
SCRIPTS = r"(?is)<script\b.*?</script>"
STYLES = r"(?is)<style\b.*?</style>"
TAG = r"<[^>]+>"
P_OPEN = r"(?i)<p\b[^>]*>"
P_CLOSE = r"(?i)</p\s*>"
H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"
H2 = r"(?is)<h2\b[^>]*>(.*?)</h2>"
META_TAG = r"(?is)<meta\b[^>]*?\sname\s*=\s*[\"']description[\"'][^>]*>"     # attributes in any order
META_CONTENT = r"(?is)\scontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
HREF = r"(?i)<a\b[^>]*?\shref\s*=\s*(\"[^\"]*\"|'[^']*')"
URL_BASE = r"^(https?://[^/?#]+)"
URL_PATH = r"^https?://[^/?#]+([^?#]*)"


def _decode(c):
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def fragment_text(c):
    """Visible text of an HTML fragment: tags -> space, entities, whitespace."""
    return T.strip(F.regexp_replace(_decode(F.regexp_replace(c, TAG, " ")), T.WS_RUN, " "))


def body_html(html):
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, COMMENTS, " "), SCRIPTS, " "), STYLES, " ")


def _quoted(c, pattern):
    """The attribute value of a pattern with a group for either kind of quotes."""
    return F.concat(F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2))


def page_fields(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add name (h1, else h2), description (first 3 paragraphs joined by a
    space), meta_description and page_text."""
    b = "_body"
    d = pages.withColumn(b, body_html(F.col(html_col)))
    h1 = fragment_text(F.regexp_extract(b, H1, 1))
    h2 = fragment_text(F.regexp_extract(b, H2, 1))
    marked = F.regexp_replace(F.regexp_replace(F.col(b), P_OPEN, "\u0002"), P_CLOSE, "\u0003")
    paras = F.transform(F.slice(F.split(marked, "\u0002"), 2, 3),
                        lambda p: fragment_text(F.substring_index(p, "\u0003", 1)))
    return d.select("*",
                    F.when(h1 != "", h1).otherwise(h2).alias("name"),
                    F.array_join(paras, " ").alias("description"),
                    T.strip(_quoted(F.regexp_extract(F.col(html_col), META_TAG, 0), META_CONTENT)).alias("meta_description"),
                    fragment_text(F.col(b)).alias("page_text")).drop(b)


def sizes(text, rules: str = "a"):
    """Size words contained in the text (any case), else the default list."""
    found = F.array_remove(F.array(*[F.when(F.lower(text).contains(s.lower()), F.lit(s)).otherwise(F.lit(""))
                                     for s in LX.SIZE_WORDS[rules]]), "")
    default = F.array(*[F.lit(s) for s in LX.DEFAULT_SIZES[rules]])
    return F.when(F.size(found) > 0, found).otherwise(default)


def calories(text):
    """First ``<digits> calorie`` (any case) as a string, when 'calorie' occurs."""
    m = F.regexp_extract(text, r"(?i)(\d+)\s*calorie", 1)
    return F.when(F.lower(text).contains("calorie") & (m != ""), m)


def temperature(name, category, rules: str = "a"):
    n, c = F.lower(name), F.lower(category)
    if rules == "a":
        return (F.when(n.contains("iced") | c.contains("cold"), F.lit("cold"))
                .when(c.contains("frappuccino") | n.contains("frappuccino"), F.lit("frozen"))
                .otherwise(F.lit("hot")))
    t = F.lower(F.concat_ws(" ", category, name))
    return (F.when(t.contains("iced") | t.contains("cold"), F.lit("cold"))
            .when(t.contains("frozen") | t.contains("coolatta"), F.lit("frozen"))
            .otherwise(F.lit("hot")))


def has_caffeine(name, description, rules: str = "a"):
    t = F.lower(F.concat_ws(" ", name, description))
    if rules == "a":
        tea = t.contains("tea") | t.contains("herbal") | t.contains("rooibos")
        return (F.when(t.contains("decaf"), F.lit(False))
                .when(tea, ~(t.contains("herbal") | t.contains("rooibos")))
                .otherwise(F.lit(True)))
    return ~t.contains("decaf")


def is_seasonal(name, rules: str = "a"):
    return T.contains_any(name, LX.SEASONAL_WORDS[rules])


def customization_groups(spark) -> DataFrame:
    """The fixed per-source option lists as a tiny dimension (source, group, options)."""
    rows = [(src, grp, opts) for src, groups in LX.CUSTOMIZATIONS.items() for grp, opts in groups]
    return spark.createDataFrame(rows, "source string, group_name string, options array<string>")


def menu_items(items: DataFrame, rules: str) -> DataFrame:
    """items(name, category, description, page_text) -> inferred attributes, with the
    ``customizations`` (group -> options) and ``nutrition`` (fact -> value) maps."""
    groups = [x for name, options in LX.CUSTOMIZATIONS[rules] for x in (F.lit(name), F.array(*[F.lit(o) for o in options]))]
    empty = F.create_map().cast("map<string,string>")
    found = calories(F.col("page_text"))
    return items.select(
        "*",
        temperature(F.col("name"), F.col("category"), rules).alias("temperature"),
        has_caffeine(F.col("name"), F.col("description"), rules).alias("has_caffeine"),
        is_seasonal(F.col("name"), rules).alias("is_seasonal"),
        sizes(F.col("page_text"), rules).alias("sizes"),
        found.alias("calories"),
        F.create_map(*groups).alias("customizations"),
        F.when(found.isNotNull(), F.create_map(F.lit("calories"), found)).otherwise(empty).alias("nutrition"))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               segments: int = 3, section: str = "menu") -> DataFrame:
    """Distinct links of each page (sorted), made absolute against the page's
    scheme and host (anchors only, either kind of quotes), with their path segment count and a category flag
    (exactly ``segments`` segments, the 2nd equal to ``section``)."""
    base = F.regexp_extract(F.col(url_col), URL_BASE, 1)
    quoted = F.regexp_extract_all(F.col(html_col), F.lit(HREF), 1)
    links = F.array_sort(F.array_distinct(F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))))
    d = (pages.select("page_id", base.alias("base"), F.explode_outer(links).alias("link"))
         .where(F.col("link").isNotNull()))
    absolute = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(F.concat("base", "link"))
    path = F.regexp_extract(absolute, URL_PATH, 1)
    segs = F.filter(F.split(path, "/"), lambda x: x != "")
    return d.select("page_id", "link", absolute.alias("absolute_url"),
                    F.size(segs).cast("long").alias("n_segments"),
                    F.coalesce((F.size(segs) == segments) & (F.try_element_at(segs, F.lit(2)) == section),
                               F.lit(False)).alias("is_category"))


# FIXED VALUES: link patterns of the two menu sites (the character classes
# include a backslash and a hyphen, as written in the collectors)
PRODUCT_LINK = r"/menu/product/[a-zA-Z0-9\\-]+"
ITEM_LINK = r"(?i)/en/menu/[a-z0-9\\-]+/[a-z0-9\\-]+"
STATE_NAMES = ["__BOOTSTRAP", "__PRELOADED_STATE__", "__INITIAL_STATE__", "__APOLLO_STATE__"]
ANCHOR = r"(?is)<a\b[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def _path(href):
    """urlparse(href).path for absolute or relative hrefs."""
    return F.when(href.startswith("http"), F.regexp_extract(href, URL_PATH, 1)) \
        .otherwise(F.regexp_extract(href, r"^([^?#]*)", 1))


def _segments(path):
    return F.filter(F.split(path, "/"), lambda x: x != "")


def state_links(html, pattern: str = PRODUCT_LINK):
    """Links in the JSON states a page assigns in its scripts (``window.<name> = {...}``): those of the first
    state, by the order of STATE_NAMES, that has any.

    A state is parsed and written out again before it is searched, so slashes that the page escapes count.
    """
    out = F.array().cast("array<string>")
    for name in reversed(STATE_NAMES):
        text = F.regexp_extract(html, r"(?s)window\." + name + r"\s*=\s*(\{.*?\})\s*;?\s*</script>", 1)
        told = F.to_json(F.try_parse_json(F.nullif(text, F.lit(""))))
        found = F.coalesce(F.regexp_extract_all(told, F.lit(pattern), 0), F.array().cast("array<string>"))
        out = F.when(F.size(found) > 0, found).otherwise(out)
    return out


def body_links(bodies: DataFrame, pattern: str) -> DataFrame:
    """(page_id, links): links in the JSON bodies (page_id, mime_type, body) captured while a page was loaded."""
    found = bodies.where(F.contains("mime_type", F.lit("application/json"))).select(
        "page_id", F.explode(F.regexp_extract_all("body", F.lit(pattern), 0)).alias("link")).distinct()
    return found.groupBy("page_id").agg(F.array_sort(F.collect_list("link")).alias("links"))


def menu_links(pages: DataFrame, url_col: str = "url", html_col: str = "html", bodies: DataFrame | None = None) -> DataFrame:
    """Per page: product links (menu A), item links and categories (menu B).

    Each list is the first non-empty of its ordered sources -- page links,
    then a regex over the raw page source, then (product links) the page's JSON
    states, then the captured JSON ``bodies`` if given -- as a sorted distinct list.
    Categories: links under ``/en/menu/`` whose path has exactly three
    segments with ``menu`` second, first anchor per path, named by its
    anchor text or else the title-cased last segment.
    """
    html = F.col(html_col)
    base = F.regexp_extract(F.col(url_col), URL_BASE, 1)
    hrefs = F.regexp_extract_all(html, F.lit(ANCHOR), 1)
    texts = F.regexp_extract_all(html, F.lit(ANCHOR), 2)
    d = pages.select("page_id", base.alias("base"), hrefs.alias("hrefs"), texts.alias("texts"), html.alias("src"))
    dom_products = F.transform(F.filter("hrefs", lambda h: h.contains("/menu/product/")),
                               lambda h: F.replace(h, F.col("base"), F.lit("")))
    src_products = F.regexp_extract_all(F.col("src"), F.lit(PRODUCT_LINK), 0)
    menu_hrefs = F.filter("hrefs", lambda h: h.contains("/en/menu/"))
    dom_items = F.transform(
        F.filter(menu_hrefs, lambda h: (F.size(_segments(_path(h))) >= 4)
                 & (F.try_element_at(_segments(_path(h)), F.lit(2)) == "menu")), _path)
    src_items = F.regexp_extract_all(F.col("src"), F.lit(ITEM_LINK), 0)

    def first_nonempty(*sources):
        out = F.array().cast("array<string>")
        for links in reversed(sources):
            links = F.array_sort(F.array_distinct(links))
            out = F.when(F.size(links) > 0, links).otherwise(out)
        return out

    anchors = F.arrays_zip(F.col("hrefs").alias("href"), F.col("texts").alias("text"))
    cats = F.filter(anchors, lambda a: a["href"].contains("/en/menu/")
                    & (F.size(_segments(_path(a["href"]))) == 3)
                    & (F.try_element_at(_segments(_path(a["href"])), F.lit(2)) == "menu")
                    & ~_path(a["href"]).endswith("/menu"))
    cats = F.transform(cats, lambda a: F.struct(_path(a["href"]).alias("path"),
                                                fragment_text(a["text"]).alias("text")))
    paths = F.transform(cats, lambda c: c["path"])
    firsts = F.filter(cats, lambda c, i: F.array_position(paths, c["path"]) == i + 1)
    named = F.transform(firsts, lambda c: F.struct(
        c["path"].alias("path"),
        F.when(c["text"] != "", c["text"]).otherwise(
            F.initcap(F.replace(F.element_at(_segments(c["path"]), -1), F.lit("-"), F.lit(" ")))).alias("name")))
    out = d.select("page_id",
                   first_nonempty(dom_products, src_products, state_links(F.col("src"))).alias("product_links"),
                   first_nonempty(dom_items, src_items).alias("item_links"),
                   named.alias("categories"))
    for column, pattern in (("product_links", PRODUCT_LINK), ("item_links", ITEM_LINK)) if bodies is not None else ():
        captured = body_links(bodies, pattern).select(F.col("page_id").alias("_page"), "links")
        out = out.join(captured, out["page_id"] == captured["_page"], "left").withColumn(
            column, F.when(F.size(column) > 0, F.col(column)).otherwise(F.coalesce("links", F.col(column)))).drop("_page", "links")
    return out
