"""Substring hits of a lexicon kept as a table, by a q-gram index.

A term can only occur where all its q-grams do.  Grams that follow a space are
met once a word, not once a character, so a term is filed under the rarest of
its grams of that kind, rarity being the number of times the documents hold the
gram.  They have q characters, or as many as the term has after its first
space; a term with fewer than ``SHORT`` of these is filed under the rarest of
all its q-grams, and one shorter than q under itself.

Grams are met by 64-bit hashes; equal hashes only make one more pair to verify.
Both joins are on keys (gram, then document id), so nothing is a nested loop
however large the lexicon is.  The filed grams are written before the documents
are read, so that Spark knows their size and broadcasts them if it allows: the
documents' grams are then met where they are made and not shuffled.  Adaptive
execution splits a gram that many documents hold.  Grams come from one regular
expression per length and kind, in one pass over a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.operators.upsert import write_snapshot

Q = 8
SHORT = 4               # least size of the grams that follow a space


def grams(text, size: int):
    """The distinct ``size``-character grams of a text column."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


def after_spaces(text, size: int):
    """The ``size`` characters after each space of a text column, as often as they stand there."""
    return F.regexp_extract_all(text, F.lit(f"(?s) (?=(.{{{size}}}))"), 1)


def _key():
    return F.xxhash64("gram").alias("key")


def _made(text, spaced: bool, size: int):
    return after_spaces(text, size) if spaced else grams(text, size)


def _gram_rows(docs: DataFrame, id_col: str, text_col: str, kinds: list[tuple[bool, int]]) -> DataFrame:
    """(doc_id, key): every gram of the kinds and sizes by its hash, once per document or, after a space, once per place."""
    text = F.lower(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), F.explode_outer(F.concat(*[_made(text, *k) for k in kinds])).alias("gram"))
            .where(F.col("gram").isNotNull()).select("doc_id", _key()))


def _filed(lexicon: DataFrame, term_col: str, q: int):
    """(term, gram) of each lower-case term's grams of its kind, written down; and the kinds in use, as (whether
    the grams follow a space, size)."""
    terms = lexicon.select(F.lower(F.col(term_col)).alias("term")).where(F.length("term") > 0).distinct()
    tail = F.length("term") - F.instr("term", " ")
    terms = terms.withColumn("spaced", (F.instr("term", " ") > 0) & (tail >= min(SHORT, q)))
    terms = terms.withColumn("size", F.least(F.when(F.col("spaced"), tail).otherwise(F.length("term")), F.lit(q)))
    own = [F.when((F.col("spaced") == spaced) & (F.col("size") == n), _made(F.col("term"), spaced, n))
           for spaced in (False, True) for n in range(1, q + 1)]
    each = terms.select("term", "spaced", "size", F.explode_outer(F.array_distinct(F.coalesce(*own))).alias("gram"))
    filed = lexicon.sparkSession.read.schema(each.schema).parquet(write_snapshot(each, "filed-grams"))
    kinds = sorted((r["spaced"], r["size"]) for r in filed.select("spaced", "size").distinct().collect())   # 2 q at most
    return filed.select("term", "gram"), kinds


def _rarest(docs: DataFrame, id_col: str, text_col: str, filed: DataFrame, kinds: list[tuple[bool, int]]) -> DataFrame:
    seen = _gram_rows(docs, id_col, text_col, kinds).join(filed.select(_key()).distinct(), "key", "left_semi")
    held = seen.groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
    told = filed.withColumn("key", _key()).join(held, "key", "left").groupBy("term").agg(
        F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "gram")).alias("rarest"))
    return told.where(F.col("rarest.docs") > 0).select(F.col("rarest.gram").alias("gram"), "term")


def gram_index(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, term_col: str = "term", q: int = Q):
    """(gram, term): each lower-case term once, under the gram of its kind that the documents hold least (ties: the
    first in order); and the gram sizes in use.  Terms with a gram that no document holds are left out."""
    filed, kinds = _filed(lexicon, term_col, q)
    if not kinds:
        return filed.select("gram", "term"), []
    return _rarest(docs, id_col, text_col, filed, kinds), sorted({n for _, n in kinds})


def substring_join(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, term_col: str = "term",
                   q: int = Q) -> DataFrame:
    """(doc_id, term) for every lower-case term that occurs anywhere in the lower-case text, once per row of
    ``docs``.  Null texts, null and empty terms hit nothing; repeated terms count once."""
    filed, kinds = _filed(lexicon, term_col, q)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text"))
    if not kinds:
        return texts.select("doc_id", F.col("text").alias("term")).limit(0)
    index = _rarest(docs, id_col, text_col, filed, kinds)
    index = docs.sparkSession.read.schema(index.schema).parquet(write_snapshot(index, "gram-index"))
    pairs = _gram_rows(docs, id_col, text_col, kinds).join(index.select(_key(), "term"), "key").select(F.col("doc_id").alias("met"), "term").distinct()
    return (texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("met"))).where(F.contains("text", "term"))
            .select("doc_id", "term"))
