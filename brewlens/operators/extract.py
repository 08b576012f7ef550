"""Text mining of posts: flavors with context, roasters, origins, brew methods,
price, keywords, word count and sentiment (one projection per document).

Per-document facts are built as arrays inside a single projection (higher
order functions: ``transform``/``filter``), so extraction is narrow -- no
shuffle -- and the top-3 "primary" flag is computed against the document's own
fact array (at most one entry per lexicon term).  Only keywords need a
shuffle (token counts per document).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX
from brewlens.functions import text as T


def _any_contains(x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {T.sql_str(w)})" for w in words) + ")"


def intensity_sql(ctx: str) -> str:
    """Later marker levels override earlier ones: subtle > moderate > prominent."""
    whens = " ".join(f"WHEN {_any_contains(ctx, markers)} THEN {T.sql_str(level)}"
                     for level, markers in reversed(LX.INTENSITY_MARKERS))
    return f"CASE {whens} ELSE 'moderate' END"


def confidence_sql(ctx: str, sent: str) -> str:
    """0.6 base, 0.75 when the context is longer than 20 characters, +0.1 when
    |sentiment| > 0.5 (capped at 1.0), rounded to 2 places."""
    return (f"CASE WHEN length({ctx}) > 20 THEN "
            f"(CASE WHEN abs({sent}) > 0.5 THEN CAST(0.85 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END) "
            f"ELSE (CASE WHEN abs({sent}) > 0.5 THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END) END")


def _cut(sql: str, context_chars: int | None) -> str:
    return sql if context_chars is None else f"substring({sql}, 1, {context_chars})"


def flavor_facts(df: DataFrame, text_col: str, out: str = "flavors",
                 terms: Sequence[str] = LX.FLAVOR_TERMS, context_chars: int | None = LX.CONTEXT_CHARS,
                 low_col: str | None = None) -> DataFrame:
    """Add ``out``: array<struct<term, ord, context, sentiment, intensity,
    confidence, is_primary>> for the flavor terms contained in ``text_col``.

    Context = first sentence (of the lower-cased text) containing the term;
    sentiment of the context (0.0 when empty); primary = top 3 by confidence,
    ties by lexicon order.  The context is stored up to ``context_chars`` (None: whole).
    ``low_col`` names the lower-cased text where it is at hand.
    """
    lt, sents, hits, f0, f1, f2 = (f"_{out}_{n}" for n in ("lt", "sents", "hits", "f0", "f1", "f2"))
    d = df.withColumn(lt, F.col(low_col) if low_col else F.lower(F.col(text_col)))
    d = d.withColumn(sents, T.sentences(F.col(lt))).withColumn(hits, T.lexicon_hits(F.col(lt), terms, lowered=True))
    d = d.withColumn(f0, F.expr(
        f"transform({hits}, (t, i) -> named_struct('term', t, 'ord', i + 1, "
        f"'context', coalesce(try_element_at(filter({sents}, s -> contains(s, t)), 1), '')))"))
    d = d.withColumn(f1, F.expr(
        f"transform({f0}, f -> named_struct('term', f.term, 'ord', f.ord, 'context', f.context, "
        f"'sentiment', CASE WHEN f.context = '' THEN CAST(0.0 AS DOUBLE) ELSE {T.sentiment_sql('f.context')} END))"))
    d = d.withColumn(f2, F.expr(
        f"transform({f1}, f -> named_struct('term', f.term, 'ord', f.ord, 'context', f.context, "
        f"'sentiment', f.sentiment, 'intensity', {intensity_sql('f.context')}, "
        f"'confidence', {confidence_sql('f.context', 'f.sentiment')}))"))
    d = d.withColumn(out, F.expr(
        f"transform({f2}, f -> named_struct('term', f.term, 'ord', f.ord, "
        f"'context', {_cut('f.context', context_chars)}, 'sentiment', f.sentiment, "
        f"'intensity', f.intensity, 'confidence', f.confidence, "
        f"'is_primary', size(filter({f2}, g -> g.confidence > f.confidence OR "
        f"(g.confidence = f.confidence AND g.ord < f.ord))) < {LX.PRIMARY_FLAVORS}))"))
    return d.drop(lt, sents, hits, f0, f1, f2)


def roaster_facts(df: DataFrame, text_col: str, out: str = "roasters",
                  names: Sequence[str] = LX.KNOWN_ROASTERS, context_chars: int | None = LX.CONTEXT_CHARS) -> DataFrame:
    """Add ``out``: array<struct<name, context>> of roaster mentions.

    Known names contained in the lower-cased text (title-cased, context = the
    first '.'-separated segment containing it, stripped, <= 200 chars), then
    ``<Capitalised words> Coffee`` pattern matches whose lower case is not yet
    present (context '').  Runs on the original (uncleaned) text.
    """
    low, segs, known, pat = (f"_{out}_{n}" for n in ("low", "segs", "known", "pat"))
    titled = {n: n.title() for n in names}
    edge = "'" + T.EDGE_WS.replace("\\", "\\\\") + "'"      # a SQL literal: backslashes count twice
    segment = f"regexp_replace(coalesce(try_element_at(filter({segs}, s -> contains(lower(s), n)), 1), ''), {edge}, '')"
    d = df.withColumn(low, F.lower(F.col(text_col))).withColumn(segs, F.split(F.col(text_col), "[.]", -1))
    d = d.withColumn(known, F.expr(
        f"transform({_hits_sql(low, names)}, n -> named_struct("
        f"'name', {_case_map('n', titled)}, 'context', {_cut(segment, context_chars)}))"))
    d = d.withColumn(pat, T.brand_names(text_col))
    d = d.withColumn(out, F.expr(
        f"concat({known}, transform(filter(transform({pat}, (m, i) -> named_struct('m', m, 'i', i)), "
        f"x -> NOT array_contains(transform({known}, k -> lower(k.name)), lower(x.m)) "
        f"AND array_position(transform({pat}, y -> lower(y)), lower(x.m)) = x.i + 1), "
        f"x -> named_struct('name', x.m, 'context', '')))"))
    return d.drop(low, segs, known, pat)


def _hits_sql(low_col: str, words: Sequence[str]) -> str:
    """SQL: the lexicon words contained in ``low_col`` in lexicon order."""
    items = ", ".join(f"CASE WHEN contains({low_col}, {T.sql_str(w)}) THEN {T.sql_str(w)} ELSE '' END" for w in words)
    return f"array_remove(array({items}), '')"


def _case_map(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {T.sql_str(k)} THEN {T.sql_str(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} END"


def compat_origin_name(c):
    """The original normalisation: drop every 'n' when the term ends in 'n', title-case."""
    return F.initcap(F.when(c.endswith("n"), F.replace(c, F.lit("n"), F.lit(""))).otherwise(c))


def origin_names(df: DataFrame, text_col: str, out: str = "origins", mode: str = "canonical",
                 low_col: str | None = None) -> DataFrame:
    """Add ``out``: distinct origin names (first occurrence order, lexicon order).

    ``mode='canonical'`` maps each term to its country; ``'compat'`` keeps the
    original string rule (``kenyan`` -> ``Keya``).  ``low_col`` names the
    lower-cased text where it is at hand.
    """
    hits, low = f"_{out}_hits", f"_{out}_low"
    # lower-case once: the hit array is consumed by a higher-order function,
    # which is evaluated without common-subexpression elimination
    d = df.withColumn(low, F.col(low_col) if low_col else F.lower(F.col(text_col)))
    d = d.withColumn(hits, T.lexicon_hits(F.col(low), LX.ORIGIN_TERMS, lowered=True)).drop(low)
    if mode == "compat":
        names = F.transform(hits, compat_origin_name)
    else:
        names = F.transform(hits, _canonical)
    return d.withColumn(out, F.array_distinct(names)).drop(hits)


def _canonical(t):
    e = None
    for term, country in LX.ORIGIN_CANONICAL.items():
        e = F.when(t == term, F.lit(country)) if e is None else e.when(t == term, F.lit(country))
    return e


def extract_posts(posts: DataFrame, id_col: str = "id", title_col: str = "title",
                  body_col: str = "body", flavor_terms: Sequence[str] = LX.FLAVOR_TERMS,
                  sentiment_fn=None, context_chars: int | None = LX.CONTEXT_CHARS) -> DataFrame:
    """One-pass extraction for every post with at least 10 characters of text.

    Returns id, cleaned_text, sentiment_score, word_count, flavors, roasters,
    origins, brew_methods, process_methods, price.  Roasters and price read
    the uncleaned text; everything else the cleaned text.  Keywords are a
    separate shuffle stage (:func:`keywords`).

    ``sentiment_fn`` is the scorer hook: a function from a column name to a
    Column (for example a user's pandas UDF); by default the built-in lexicon
    scorer, which stays in the JVM.  ``context_chars`` cuts stored contexts (None: whole).
    """
    d = posts.select(F.col(id_col).alias("id"), T.joined_text(title_col, body_col).alias("_joined"))
    d = d.select("id", T.strip_column("_joined").alias("raw_text"))
    d = d.where(F.length("raw_text") >= LX.MIN_TEXT_CHARS)
    d = d.withColumn("cleaned_text", T.clean_column("raw_text"))
    d = d.withColumn("sentiment_score", (sentiment_fn or T.sentiment)("cleaned_text"))
    d = d.withColumn("_lowered", F.lower("cleaned_text"))     # once, for all that read it
    d = d.withColumn("word_count", T.word_count("_lowered"))
    d = flavor_facts(d, "cleaned_text", terms=flavor_terms, context_chars=context_chars, low_col="_lowered")
    d = roaster_facts(d, "raw_text", context_chars=context_chars)
    d = origin_names(d, "cleaned_text", low_col="_lowered")
    d = d.withColumn("brew_methods", T.lexicon_hits("_lowered", LX.BREW_METHODS, lowered=True))
    d = d.withColumn("process_methods", F.array().cast("array<string>"))
    d = d.withColumn("price", T.first_price("raw_text"))
    return d.drop("raw_text", "_lowered")


def processed_reviews(extracted: DataFrame, now: str | None = None, language: str = LX.LANGUAGE) -> DataFrame:
    """``processed_reviews`` rows of :func:`extract_posts` output (``now``: processing time, default the clock)."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return extracted.select(F.col("id").cast("string").alias("post_id"), "cleaned_text", "sentiment_score",
                            F.lit(language).alias("language"), "word_count", at.alias("processed_at"))


def _with_top_tokens(df: DataFrame, tokens, top_n: int, out: str) -> DataFrame:
    """Add ``out``: array<struct<less, pos, token>> of a row's ``top_n`` tokens by count (``less`` is the negative
    count), ties by first occurrence.

    All in the row: (token, position) pairs are sorted, equal tokens stand in runs, and a run's length is its
    count.  What the lambdas read is a column of its own at each step.
    """
    words, runs, starts = (f"_{out}_{n}" for n in ("words", "runs", "starts"))
    d = df.withColumn(words, tokens)
    d = d.withColumn(runs, F.sort_array(F.transform(words, lambda x, i: F.struct(x.alias("token"), i.alias("pos")))))
    begins = F.transform(runs, lambda x, i: F.when((i == 0) | (x["token"] != F.get(runs, i - 1)["token"]), i))
    d = d.withColumn(starts, F.filter(begins, lambda x: x.isNotNull()))
    counted = F.transform(starts, lambda a, k: F.struct(
        (a - F.coalesce(F.get(starts, k + 1), F.size(runs))).alias("less"), F.get(runs, a)["pos"].alias("pos"),
        F.get(runs, a)["token"].alias("token")))
    return d.withColumn(out, F.slice(F.sort_array(counted), 1, top_n)).drop(words, runs, starts)


def _keyword_tokens(text_col: str, stop_words: Sequence[str]):
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(T.KEYWORD_TOKENS), 0)
    return F.filter(words, lambda x: ~x.isin(list(stop_words)))


def keywords(df: DataFrame, id_col: str, text_col: str, top_n: int = LX.KEYWORDS_TOP_N,
             stop_words: Sequence[str] = LX.STOP_WORDS, token_hook=None) -> DataFrame:
    """Top-N tokens per document by count, ties by first occurrence; nothing is exchanged.

    Tokens are lower-case alphabetic runs minus stop words; ``token_hook``
    (Column -> Column, e.g. a pandas UDF running a tagger) may map each token
    to its lemma or to null to drop it.  A UDF cannot run inside an array
    function, so with a hook each token is a row until the hook has run.
    """
    tokens = _keyword_tokens(text_col, stop_words)
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    if token_hook is None:
        d = _with_top_tokens(d, _keyword_tokens("_text", stop_words), top_n, "top")
    else:
        each = df.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(tokens).alias("pos", "token"))
        each = each.where(F.col("token").isNotNull()).withColumn("token", token_hook(F.col("token")))
        lists = each.where(F.col("token").isNotNull()).groupBy("doc_id").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("_tokens"))
        d = _with_top_tokens(lists, F.col("_tokens"), top_n, "top")
    # the _outer form: a plain explode makes the optimizer infer a size > 0
    # filter, which would tokenize every text twice (once below any repartition)
    ranked = d.select("doc_id", F.posexplode_outer("top").alias("place", "t")).where(F.col("t").isNotNull())
    return ranked.select("doc_id", (F.col("place") + 1).cast("long").alias("rank"), F.col("t.token").alias("keyword"),
                         (-F.col("t.less")).cast("long").alias("cnt"))


def sentiment_join(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                   negators: Sequence[str] = tuple(LX.NEGATORS), factor: float = LX.NEGATION_FACTOR) -> DataFrame:
    """(doc_id, sentiment): the lexicon score with the lexicon as a table (word, polarity) of any size.

    The same rule as :func:`brewlens.functions.text.sentiment_sql`: every token that is a word of the
    lexicon adds its polarity, times ``factor`` after a negator; the score is the mean, 0.0 without a hit.
    Tokens (with the one before) are equi-joined with the lexicon; ids are unique.  A word given
    twice counts with its larger polarity.
    """
    words = lexicon.groupBy(F.lower("word").alias("word")).agg(F.max("polarity").alias("polarity"))
    d = docs.select(F.col(id_col).alias("doc_id"),
                    F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(T.WORD_TOKENS), 0).alias("_tokens"))
    pairs = F.transform("_tokens", lambda x, i: F.struct(x.alias("word"), F.when(i > 0, F.get("_tokens", i - 1)).alias("before")))
    said = d.select("doc_id", F.explode_outer(pairs).alias("t")).where(F.col("t").isNotNull()).select("doc_id", "t.word", "t.before")
    weight = F.when(F.col("before").isin(list(negators)), F.lit(factor)).otherwise(F.lit(1.0))
    scored = said.join(words, "word").groupBy("doc_id").agg(F.avg(F.col("polarity") * weight).alias("sentiment"))
    return docs.select(F.col(id_col).alias("doc_id")).join(scored, "doc_id", "left").select(
        "doc_id", F.coalesce("sentiment", F.lit(0.0)).alias("sentiment"))


def drink_mentions(posts: DataFrame, comments: DataFrame, post_key: str = "post_id",
                   k: int = LX.COMMENTS_FIRST_K, min_score: int = LX.COMMENT_MIN_SCORE,
                   terms: Sequence[str] = LX.DRINK_TERMS) -> DataFrame:
    """Drinks mentioned in title + body + kept comments of each post.

    Comments (post_key, seq, body, score) are pruned to the first ``k`` per
    post, then to ``score >= min_score``; the kept bodies (at most ``k`` per
    post) are gathered per post and joined back.
    """
    w = Window.partitionBy(post_key).orderBy("seq")
    kept = (comments.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .where(F.col("score") >= min_score))
    bodies = (kept.groupBy(post_key)
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "body"))),
                                            lambda s: s["body"]), " ").alias("_comments")))
    j = posts.join(bodies, post_key, "left")
    text = F.concat_ws(" ", F.col("title"), F.col("body"), F.coalesce(F.col("_comments"), F.lit("")))
    return j.select(post_key, T.lexicon_hits(text, terms).alias("mentioned_drinks"))


def with_keywords(extracted: DataFrame, top_n: int = LX.KEYWORDS_TOP_N) -> DataFrame:
    """Attach each post's top-N keywords (in rank order) to the extraction, in the row."""
    d = _with_top_tokens(extracted, _keyword_tokens("cleaned_text", LX.STOP_WORDS), top_n, "_top")
    return d.withColumn("keywords", F.transform("_top", lambda x: x["token"])).drop("_top")


WORD = r"[a-z0-9]+"


def words_of(text):
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def word_ngrams(words, lengths=(1, 2)):
    """Distinct word n-grams of a word-array column, of the given lengths (a number n: 1..n).

    ``words`` must be a column reference, not an expression: inside the
    interpreted ``transform`` lambda an expression would be re-evaluated for
    every position.
    """
    lengths = range(1, lengths + 1) if isinstance(lengths, int) else lengths

    def gram_at(n):  # one-argument lambda: transform passes (element, index) to two-argument ones
        return lambda i: F.array_join(F.slice(words, i, n), " ")

    grams = [words if n == 1 else
             F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), gram_at(n)))
             .otherwise(F.array().cast("array<string>")) for n in lengths]
    return F.array_distinct(F.concat(*grams))


def lexicon_join(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, term_col: str = "term") -> DataFrame:
    """Whole-word lexicon hits for a lexicon kept as a table (any size).

    Each document's distinct word n-grams are equi-joined with the lexicon
    terms: a hash join that Spark/AQE broadcasts when the lexicon's measured
    size allows and otherwise shuffles on the n-gram -- never a nested loop.
    Unlike :func:`brewlens.functions.text.lexicon_hits` (substring semantics
    for small fixed lexicons) a term must match whole words.  The n-grams are
    as long as the lexicon's own terms: only lengths that occur are made.
    """
    lex = lexicon.select(F.array_join(words_of(F.col(term_col)), " ").alias("gram"), F.size(words_of(F.col(term_col))).alias("n"))
    lengths = sorted(r["n"] for r in lex.select("n").distinct().collect() if r["n"])   # one number per term length
    w = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("_words"))
    g = (w.select("doc_id", F.explode_outer(word_ngrams(F.col("_words"), lengths or [1])).alias("gram"))
         .where(F.col("gram").isNotNull()))
    lex = lex.where("n > 0").select("gram").distinct()
    return g.join(lex, "gram").select("doc_id", F.col("gram").alias("term"))
