"""Column-expression builders for text work.

All of these return ``Column`` expressions built from Spark SQL functions, so
they run inside whole-stage codegen (or as JVM higher-order functions) with no
Python in the task.  Regexes stay ASCII (Java's default), matching DuckDB's RE2
for the oracle; see SURVEY traps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX

# FIXED VALUES (patterns that must match the original text rules)
URL_PATTERN = r"http\S+|www.\S+"       # the dot is unescaped on purpose
URL_STARTS = "http", "www"             # a text without these has no match
WS_RUN = r"\s+"
EDGE_WS = r"^\s+|\s+$"
WS_CHARS = " \t\n\x0b\f\r"
LINE_ENDS = "\u0085", "\u2028", "\u2029"     # no white space to the patterns, but "$" also matches before one at the end
SENTENCE_END = r"([.!?])\s+"
SENT_MARK = "\u0001"
PRICE_PATTERN = r"\$\s?(\d+(?:\.\d{1,2})?)"
# word edges spelled out in ASCII: the engines differ in what bounds a word beside accented letters
BRAND_WORD = "Coffee"                  # nor has a text without this one a match of the next
BRAND_PATTERN = r"(?<![A-Za-z0-9_])([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})\s+Coffee(?![A-Za-z0-9_])"
# END FIXED VALUES
WORD_TOKENS = r"[a-z']+"
WORD_COUNT_TOKENS = r"\w+|[^\w\s]"
KEYWORD_TOKENS = r"[a-z]+"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(s: str) -> str:
    """A SQL string literal without quotes or backslashes inside (both dialects)."""
    assert "'" not in s and "\\" not in s, s
    return "'" + s + "'"


def strip(c) -> Column:
    """Python ``str.strip()`` on ASCII whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(col_of(c), EDGE_WS, "")


def strip_column(c) -> Column:
    """:func:`strip` without trying the pattern at every character.  ``c`` is named three times: for a
    projection, where Spark computes it once; a filter would compute it each time."""
    c = col_of(c)
    return F.when(F.right(c, F.lit(1)).isin(*LINE_ENDS), F.regexp_replace(c, EDGE_WS, "")).otherwise(F.btrim(c, F.lit(WS_CHARS)))


def clean_text(c) -> Column:
    """Delete URLs, collapse whitespace runs to one space, strip."""
    no_urls = F.regexp_replace(col_of(c), URL_PATTERN, "")
    return strip(F.regexp_replace(no_urls, WS_RUN, " "))


def clean_column(name: str) -> Column:
    """:func:`clean_text` of a column, for a projection (see :func:`strip_column`)."""
    c = F.col(name)
    no_urls = F.when(reduce(or_, [c.contains(x) for x in URL_STARTS]), F.regexp_replace(c, URL_PATTERN, "")).otherwise(c)
    return strip_column(F.regexp_replace(no_urls, WS_RUN, " "))


def joined_text(title, body) -> Column:
    """``title + "\\n" + body``; a null part counts as empty."""
    return F.concat(F.coalesce(col_of(title), F.lit("")), F.lit("\n"), F.coalesce(col_of(body), F.lit("")))


def post_text(title, body) -> Column:
    """:func:`joined_text`, stripped."""
    return strip(joined_text(title, body))


def brand_names(c) -> Column:
    """The names before ``Coffee`` that ``BRAND_PATTERN`` finds in the text, in their order."""
    c = col_of(c)
    none = F.array().cast("array<string>")
    return F.when(~c.contains(BRAND_WORD), none).otherwise(F.regexp_extract_all(c, F.lit(BRAND_PATTERN), 1))


def truncate(c, n: int = LX.CONTEXT_CHARS) -> Column:
    return F.substring(col_of(c), 1, n)


def sentences(c) -> Column:
    """Split into sentences after ``.``, ``!`` or ``?`` followed by whitespace."""
    marked = F.regexp_replace(col_of(c), SENTENCE_END, "$1" + SENT_MARK)
    return F.split(marked, SENT_MARK)


def first_containing(arr: Column, term) -> Column:
    """First element of ``arr`` whose lower case contains ``term`` ('' if none)."""
    t = F.lit(term) if isinstance(term, str) else term
    hit = F.filter(arr, lambda s: F.lower(s).contains(t))
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.lit(""))


def contains_any(c, words: Sequence[str]) -> Column:
    """True when the lower-cased text contains any of ``words`` as a substring."""
    low = F.lower(col_of(c))
    out = None
    for w in words:
        e = low.contains(w.lower())
        out = e if out is None else (out | e)
    return out if out is not None else F.lit(False)


def part_of(word: str, words: Sequence[str]) -> str | None:
    """The shortest other word of the list that stands in ``word``: a text without it cannot hold ``word``."""
    return min((w for w in words if w and w != word and w in word), key=len, default=None)


def lexicon_hits(c, words: Sequence[str], lowered: bool = False, whole_word: bool = False) -> Column:
    """Array of the lexicon words contained in the text, in lexicon order.

    Substring semantics by default (``rose`` hits ``prose``, as in the
    original); ``whole_word=True`` requires word boundaries on both sides.
    The ``array_remove(array(when...))`` form stays inside whole-stage codegen.
    A word that holds another one of the list is only looked for where that one is.
    """
    import re
    low = col_of(c) if lowered else F.lower(col_of(c))

    def hit(w):
        if whole_word:
            return low.rlike(r"\b" + re.escape(w) + r"\b")
        part = part_of(w, words)
        return low.contains(w) if part is None else low.contains(part) & low.contains(w)
    items = [F.when(hit(w), F.lit(w)).otherwise(F.lit("")) for w in words]
    return F.array_remove(F.array(*items), "")


def slugify(c) -> Column:
    """lower, space -> '-', drop apostrophes."""
    return F.replace(F.replace(F.lower(col_of(c)), F.lit(" "), F.lit("-")), F.lit("'"), F.lit(""))


def normalize_name(c) -> Column:
    """lower, strip, drop apostrophes, '-' -> space."""
    return F.replace(F.replace(strip(F.lower(col_of(c))), F.lit("'"), F.lit("")),
                     F.lit("-"), F.lit(" "))


def origin_key(country, region=None) -> Column:
    reg = F.lower(col_of(region)) if region is not None else F.lit(None).cast("string")
    return F.concat(F.lower(col_of(country)), F.lit("_"), F.coalesce(reg, F.lit("general")))


def first_price(c) -> Column:
    """First ``$ 12.50``-style amount as a double, else null."""
    return F.nullif(F.regexp_extract(col_of(c), PRICE_PATTERN, 1), F.lit("")).try_cast("double")


def word_count(c) -> Column:
    """Word-ish token count: runs of word chars plus single punctuation marks."""
    return F.size(F.regexp_extract_all(col_of(c), F.lit(WORD_COUNT_TOKENS), 0)).cast("long")


# ---------------------------------------------------------------- sentiment

def _polarity_case(tok: str) -> str:
    whens = " ".join(f"WHEN {sql_str(w)} THEN {float(p)!r}" for w, p in LX.SENTIMENT_LEXICON)
    return f"(CASE {tok} {whens} END)"


def sentiment_sql(text_sql: str) -> str:
    """Lexicon sentiment in [-1, 1] as a Spark SQL expression over ``text_sql``.

    Tokens ``[a-z']+`` of the lower-cased text; each lexicon hit contributes its
    polarity, times -0.5 when the previous token is a negator; the score is
    the mean over hits, 0.0 without hits or for empty text.
    The token array is bound once through a one-element ``transform``.
    """
    negs = ", ".join(sql_str(n) for n in LX.NEGATORS)
    factor = repr(LX.NEGATION_FACTOR)
    toks = f"regexp_extract_all(lower({text_sql}), '{WORD_TOKENS.replace(chr(39), chr(92) + chr(39))}', 0)"
    words = ", ".join(sql_str(w) for w, _ in LX.SENTIMENT_LEXICON)     # one look-up a token; the CASE is for hits only
    prev = f"CASE WHEN i > 0 AND get(t, i - 1) IN ({negs}) THEN {factor} ELSE 1.0 END"
    scores = (f"filter(transform(coalesce(t, array()), (w, i) -> CASE WHEN w IN ({words}) THEN {_polarity_case('w')} * ({prev}) END), "
              f"x -> x IS NOT NULL)")
    body = ("CASE WHEN size(s) = 0 THEN CAST(0.0 AS DOUBLE) ELSE "
            "aggregate(s, CAST(0.0 AS DOUBLE), (a, x) -> a + x) / size(s) END")
    return (f"element_at(transform(array({toks}), t -> "
            f"element_at(transform(array({scores}), s -> {body}), 1)), 1)")


def sentiment(c) -> Column:
    """Column version of :func:`sentiment_sql` for Spark (takes a column name)."""
    return F.expr(sentiment_sql(f"`{c}`"))
