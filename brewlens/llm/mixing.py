"""Mixing sources to target weights by iterative proportional fitting.

Documents are folded into cells (source, language, topic) with their token
counts.  Every value of a dimension has a factor; a cell's documents are drawn
with probability ``min(1, product of its three factors)``.  Raking goes over
the dimensions in turn and sets each factor so that the expected tokens of its
value meet their target, with the cells that are cut at 1 counted as they are,
so cutting does not spoil what was fitted.  It ends when a whole round finds
every value within TOLERANCE of its target, and if some target cannot be met
together with the others, when rounds no longer bring the largest error down.

Targets are shares of the token budget.  A value that has fewer tokens than
its share asks for gives all it has, and the others share the rest
(``targets``), so single targets are always within reach.

The cells stay a DataFrame: sums are grouped with partial aggregation and
joined back by merging (adaptive execution can split the cells of a frequent
value), and each step is written to the shared checkpoint folder.  One number
per round goes to the driver.  A draw depends on the id alone, so it
repeats on any cluster.

Defined cases: null source, language or topic is a value of its own; null or
empty text has 0 tokens and its cell's probability; a value without tokens
keeps the factor it starts with; equal ids are drawn together; an empty table
gives no rows; other columns ride along in ``sample``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brewlens.llm.common import written

DIMENSIONS = {"source": 0.7, "lang": 0.8, "topic": 0.9}   # target share ~ (token share) ** exponent
BUDGET = 0.6            # share of all tokens to draw
TOLERANCE = 1e-4        # of a target, for every value
STALLED = 0.99          # a round that leaves so much of the best error so far is of no use,
PATIENCE = 3            # and after so many in a row the targets cannot be met together
SPACE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, r"[\x20\x09-\x0D]+"))).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic where the table has none: the form of the whole text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    marks = chars - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = chars - F.length(F.translate(text, "\n", ""))
    return (F.when(marks * 20 > chars, "marked").when(tokens < 100, "short").when(tokens >= 1000, "long")
            .when(lines * 120 > chars, "lines").otherwise("prose"))


def measured(docs: DataFrame) -> DataFrame:
    """row (all columns of the document) and doc_id, source, lang, topic, n_tokens."""
    held = docs.select(F.struct("*").alias("row"))
    counted = held.select("row", n_words(F.col("row.text")).alias("n_tokens"))
    return counted.select("row", "row.doc_id", "row.source", "row.lang",
                          topic_of(F.col("row.text"), F.col("n_tokens")).alias("topic"), "n_tokens")


def targets(cells: DataFrame, dimensions: dict[str, float], budget: float) -> DataFrame:
    """(dimension, value, target): tokens to draw of each value of each dimension.

    Shares go by the tokens to the power of the dimension's exponent.  Values whose share is more than they
    have give all of it; what is missing is shared by the others, until no further value is short.
    """
    each = [cells.groupBy(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
            .agg(F.sum("tokens").cast("double").alias("have")).withColumn("raised", F.pow("have", F.lit(e)))
            for d, e in dimensions.items()]
    have = written(reduce(DataFrame.unionByName, each), "mix-have")
    scales: dict[str, float] = dict.fromkeys(dimensions, 0.0)
    short: dict[str, int] = dict.fromkeys(dimensions, -1)
    while True:
        scale = F.lit(0.0)
        for d, x in scales.items():
            scale = F.when(F.col("dimension") == d, F.lit(x)).otherwise(scale)
        drawn = F.least("have", F.col("raised") * scale)
        full = F.col("raised") * scale >= F.col("have")
        found = have.groupBy("dimension").agg(
            F.sum("have").alias("all"), F.sum(F.when(full, F.col("have")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("raised"))).alias("open"),
            F.count_if(full & (F.col("have") > 0)).alias("short")).collect()                  # a row a dimension
        moved = [r for r in found if r["open"] > 0 and r["short"] != short[r["dimension"]]]
        if not moved:
            return have.select("dimension", "value", drawn.alias("target"))
        for r in moved:
            scales[r["dimension"]] = (budget * r["all"] - r["full"]) / r["open"]
            short[r["dimension"]] = r["short"]


def rake(cells: DataFrame, wanted: DataFrame, dimensions, start: float, tolerance: float = TOLERANCE) -> DataFrame:
    """The cells with target_, factor_ and error_<dimension>: the error is the relative distance of the value's
    expected tokens from its target as the last round found it.

    ``cells`` has the dimensions and tokens, ``wanted`` (dimension, value, target).
    """
    state = cells
    for k, d in enumerate(dimensions):
        own = wanted.filter(F.col("dimension") == d).select(F.col("value").alias("named"), F.col("target").alias(f"target_{d}"))
        state = (state.join(own, F.col(d).cast("string").eqNullSafe(F.col("named"))).drop("named")
                 .withColumn(f"factor_{d}", F.lit(start if k == 0 else 1.0)).withColumn(f"error_{d}", F.lit(0.0)))
    state = written(state, "mix-state")
    best, idle, tokens, now = None, 0, F.col("tokens"), _product(dimensions)
    while True:
        for d in dimensions:
            # expected tokens are a sum of min(tokens, factor * others * tokens), which is concave in the
            # factor; both quotients are tangents' answers, never above the right one, and the second is exact
            # once the cells that are cut are known
            others = [x for x in dimensions if x != d]
            other = _product(others) if others else F.lit(1.0)
            sums = state.groupBy(F.col(d).alias("summed")).agg(
                F.sum(other * tokens).alias("plain"), F.sum(F.least(F.lit(1.0), now) * tokens).alias("drawn"),
                F.sum(F.when(now >= 1, tokens).otherwise(0)).alias("cut"),
                F.sum(F.when(now < 1, other * tokens).otherwise(0.0)).alias("open"))
            # a merge join: a broadcast for every step would pile up on the driver
            told = state.join(sums.hint("merge"), F.col(d).eqNullSafe(F.col("summed")))
            target = F.col(f"target_{d}")
            exact = F.when(F.col("open") > 0, (target - F.col("cut")) / F.col("open"))
            fit = F.greatest(target / F.col("plain"), exact)
            miss = F.when(target > 0, F.abs(F.col("drawn") / target - 1)).otherwise(0.0)
            # where all is cut and the target is all there is, the factor stays
            new = F.when((F.col("plain") > 0) & (miss > 1e-12), fit).otherwise(F.col(f"factor_{d}"))
            state = written(told.withColumn(f"error_{d}", miss).withColumn(f"factor_{d}", new).select(state.columns), "mix-state")
        error = state.agg(F.max(F.greatest(*[F.col(f"error_{d}") for d in dimensions], F.lit(0.0)))).first()[0] or 0.0
        idle = 0 if best is None or error < STALLED * best else idle + 1
        best = error if best is None else min(best, error)
        if error <= tolerance or idle >= PATIENCE:
            return state


def _product(dimensions) -> Column:
    return reduce(lambda a, b: a * b, [F.col(f"factor_{d}") for d in dimensions])


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only (52 bits of an md5)."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cell_probabilities(each: DataFrame, dimensions: dict[str, float], budget: float) -> DataFrame:
    """One row a cell: cell_<dimension>, weight, probability.  The weight is the uncut probability over the budget."""
    cells = written(each.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    fitted = rake(cells, targets(cells, dimensions, budget), dimensions, budget).withColumn("uncut", _product(dimensions))
    return written(fitted.select(*[F.col(d).alias(f"cell_{d}") for d in dimensions], (F.col("uncut") / budget).alias("weight"),
                                 F.least(F.lit(1.0), "uncut").alias("probability")), "mix-probabilities")


def _with_cells(each: DataFrame, cells: DataFrame, dimensions, seed: str) -> DataFrame:
    """Cells are joined back to the documents: Spark broadcasts them if they are small by
    their size on disk, else it exchanges both sides, and rows of a hot cell can be split."""
    match = reduce(lambda a, b: a & b, [each[d].eqNullSafe(cells[f"cell_{d}"]) for d in dimensions])
    return each.join(cells, match).withColumn("kept", draw(each["doc_id"], seed) < F.col("probability"))


def mix(docs: DataFrame, dimensions: dict[str, float] | None = None, budget: float = BUDGET, seed: str = ":mix") -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, kept for every document."""
    dimensions = dimensions or DIMENSIONS
    each = written(measured(docs).drop("row"), "mix-measured")
    joined = _with_cells(each, cell_probabilities(each, dimensions, budget), dimensions, seed)
    return joined.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


def sample(docs: DataFrame, dimensions: dict[str, float] | None = None, budget: float = BUDGET, seed: str = ":mix") -> DataFrame:
    """The drawn documents with all their columns."""
    dimensions = dimensions or DIMENSIONS
    cells = cell_probabilities(measured(docs).drop("row"), dimensions, budget)
    return _with_cells(measured(docs), cells, dimensions, seed).filter("kept").select("row.*").select(docs.columns)
