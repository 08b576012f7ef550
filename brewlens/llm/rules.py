"""Quality rules, line first: DataFrame functions only.

Every line of a text is judged on its own: it must end with closing
punctuation, must not be a navigation line, a boilerplate line, rich in
marks or all in capitals.  Lines that fail are removed, and a document that loses
too much of its words is rejected; so is one that fails the base rules.

All work is inside the row: no shuffle, and nothing is gathered.  Repeated
3-word windows are found by sorting one long per window (hash bits above,
position below), which compares as a primitive; the windows whose hash bits
stand beside equal ones are then sorted by their words, so hashes that only
look alike in very long texts do not count.

Defined cases: null text has no words and fails the base rules; blank lines
are kept and never count; ties and duplicate rows are judged alike; an empty
table gives no rows; other columns ride along in ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
MARKS = "#*$%&|<>"
SEPARATORS = "|>»•"
WORD = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50     # of the words, inside repeated 3-word windows
MAX_LOST_PERCENT = 30       # of the word characters, in removed lines
MAX_MARK_PERCENT = 8        # of a line's characters
MIN_CAPITAL_CHARS = 20      # a line this long without a small letter is shouted
SEPARATED = 3               # that many separators make a navigation line
CLOSING = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
NAVIGATION = r"(?i)^\s*(home|menu|login|log in|sign in|sign up|next|previous|back to top|skip to content|share this)\s*[.!|>]*\s*$"
BOILERPLATE = ["all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy",
               "enable javascript", "released under the ", "licensed under ", "subscribe to our newsletter",
               "copyright ©"]


def _without(text: Column, characters: str) -> Column:
    """The text less the characters; a chain of byte searches, which translate() is not."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(_without(text, characters))


def line_passes(line: Column) -> Column:
    """True where a line stays.  A line without a word always does."""
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    judged = (line.rlike(CLOSING)
              & ~((F.length(line) >= MIN_CAPITAL_CHARS) & (F.upper(line) == line) & (low != line))
              & ~line.rlike(NAVIGATION)
              & (_count(line, SEPARATORS) < SEPARATED)
              & (_count(line, MARKS) * 100 <= F.length(line) * MAX_MARK_PERCENT)
              & ~boilerplate)
    return ~line.rlike(WORD) | judged


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with word and line counts, ``clean_text``, ``base_failed`` and ``kept``.

    A column of ``docs`` that has a result's name is replaced by the result.
    """
    names, own = docs.columns, [F.col("_row")]
    docs = docs.select(F.struct("*").alias("_row"), "text")
    text = F.coalesce("text", F.lit(""))
    body = F.btrim(text, F.lit(SPACE))
    step = docs.select(*own, F.struct(
        text.alias("text"),
        F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+")).alias("words"),
        F.split(text, "\n", -1).alias("lines")).alias("t"))
    # bits that hold a position, and one long per 3-word window: hash above, position below
    step = step.select(*own, "t", F.size("t.words").alias("n_words"), F.length(F.bin(F.size("t.words"))).alias("bits"))
    window = F.expr("transform(t.words, (w, i) -> shiftleft("
                    "xxhash64(w, get(t.words, i + 1), get(t.words, i + 2)), bits) + i)")
    windows = F.sort_array(F.slice(window, F.lit(1), F.greatest(F.lit(0), F.col("n_words") - 2)))
    step = step.select(*own, "t", "n_words", "bits", windows.alias("windows"))
    # windows whose hash bits stand beside equal ones, with their words
    alike = F.expr("transform(filter(windows, (x, j) ->"
                   " shiftright(x, bits) <=> shiftright(get(windows, j + 1), bits)"
                   " OR shiftright(x, bits) <=> shiftright(get(windows, j - 1), bits)),"
                   " x -> x & (shiftleft(1L, bits) - 1L))")
    step = step.select(*own, "t", "n_words", alike.alias("alike"))
    told = F.expr("sort_array(transform(alike, p -> struct(concat_ws(' ', t.words[int(p)], t.words[int(p) + 1], t.words[int(p) + 2])"
                  " AS told, p AS at)))")
    step = step.select(*own, "t", "n_words", told.alias("told"))
    # positions of windows whose words stand beside equal ones, in text order
    again = F.expr("sort_array(transform(filter(told, (x, j) ->"
                   " x.told <=> get(told, j + 1).told OR x.told <=> get(told, j - 1).told), x -> x.at))")
    step = step.select(*own, "t", "n_words", again.alias("at"),
                       F.filter("t.lines", lambda x: x.rlike(WORD)).alias("full_lines"),
                       F.filter("t.lines", line_passes).alias("good_lines"))
    step = step.select(
        *own, "n_words", F.length(F.array_join("t.words", "")).cast("long").alias("word_chars"),
        _count(F.col("t.text"), MARKS).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(at, (p, j) -> least(3L, coalesce(get(at, j + 1) - p, 3L))), 0L, (a, x) -> a + x)")
        .alias("n_repeat_words"),
        (F.size("t.lines") - F.size("good_lines")).cast("long").alias("n_removed_lines"),
        F.array_join("good_lines", "\n").alias("clean_text"))
    lost = F.col("word_chars") - F.length(_without(F.col("clean_text"), SPACE))
    step = (step.withColumn("lost_chars", F.when(F.col("n_removed_lines") == 0, 0).otherwise(lost).cast("long"))
            .withColumn("n_words", F.col("n_words").cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    step = step.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))
    return step.withColumn("kept", kept).select(*[F.col("_row")[c].alias(c) for c in names if c.lower() not in RESULTS],
                                                *RESULTS)


RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "clean_text",
           "lost_chars", "base_failed", "kept"]
