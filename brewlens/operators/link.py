"""Resolving mentions to dimension tables: alias lookup, origin keys, a lossless
similarity join, and deterministic creation of new entities.

Nothing here loops over rows on the driver.  Lookups are equi-joins; only the table
of flavor aliases may be broadcast, joins of sides that grow with the input merge
(:func:`brewlens.session.merging`).  The fuzzy step
is a similarity join: two names that a ratio puts near each other have a long
common subsequence, so they share a signature (a name less a few characters);
lengths for which a name would have too many signatures go by
occurrence-numbered character bigrams and a prefix filter over the rare ones.
Together they provably keep every pair with ``ratio > 0.85``; an Arrow-batched
pandas UDF then applies difflib's cheap upper bounds and computes the exact
ratio on the survivors.  The best match is looked for among very near names
first, and further off only for names that found none there.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brewlens.functions import lexicons as LX
from brewlens.functions import text as T
from brewlens.operators.upsert import dedupe, insert_ignore
from brewlens.session import checkpoint_root, merging

# ------------------------------------------------------------ flavor aliases


def flavor_alias_table(flavor_terms: DataFrame) -> DataFrame:
    """alias -> flavor id from term, normalized_term and synonyms (lower case).

    A later entry wins: rows in id order, inside a row term, then normalized
    term, then synonyms in order.
    """
    keys = F.concat(F.array(F.lower("term"), F.lower("normalized_term")),
                    F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), F.lower))
    e = flavor_terms.select("id", F.posexplode(keys).alias("pos", "alias")).where(F.col("alias").isNotNull())
    return dedupe(e, ["alias"], ["id", "pos"], keep="last").select("alias", F.col("id").alias("flavor_term_id"))


def link_flavors(facts: DataFrame, aliases: DataFrame, context_chars: int | None = LX.CONTEXT_CHARS) -> DataFrame:
    """Flavor facts -> flavor_extractions rows (insert-ignore on review x flavor).

    ``facts``: processed_review_id, post_id, term, context, intensity, sentiment,
    confidence, is_primary, pos (position in the review's fact list).  Unknown
    terms are dropped; defaults fill missing values; the first fact per (review,
    flavor) wins, so its 1-based position is the mention_order.  ``context_chars`` cuts
    the context (None: whole).
    """
    context = F.coalesce("context", F.lit(""))
    j = facts.withColumn("_probe", T.strip(F.lower("term"))).join(aliases, F.col("_probe") == F.col("alias"), "inner")
    rows = j.select(
        "processed_review_id", "post_id", "flavor_term_id",
        F.col("term").alias("mention_text"),
        (context if context_chars is None else T.truncate(context, context_chars)).alias("sentence_context"),
        F.coalesce("intensity", F.lit("moderate")).alias("intensity"),
        F.coalesce("sentiment", F.lit(0.0)).alias("sentiment"),
        F.coalesce("confidence", F.lit(0.5)).alias("confidence_score"),
        F.coalesce("is_primary", F.lit(False)).alias("is_primary_flavor"),
        (F.col("pos") + 1).cast("int").alias("mention_order"),
        F.col("pos"))
    return dedupe(rows, ["processed_review_id", "flavor_term_id"], ["pos", "mention_text"], keep="first").drop("pos")


# ------------------------------------------------------------ origins


def find_or_create_origins(origins: DataFrame, probes: DataFrame):
    """Resolve (country, region) probes by key ``country_region`` /
    ``country_general``; unknown keys create origins (title case, id =
    xxhash64 of the key).  Spellings of one key differ in case only; the one
    that sorts first is kept, whatever the partitioning.
    Returns (lookup, new origins snapshot)."""
    p = probes.select(T.origin_key("country", "region").alias("normalized_name"), "country", "region")
    keys = dedupe(p, ["normalized_name"], ["country", "region"], "first")
    existing = origins.select("normalized_name", F.col("id").alias("_id"), F.col("country").alias("_country"),
                              F.col("region").alias("_region"))
    j = keys.join(merging(existing), "normalized_name", "left")
    created = F.col("_id").isNull()
    lookup = j.select(
        "normalized_name",
        F.coalesce("_id", F.xxhash64("normalized_name")).alias("origin_id"),
        created.alias("created"),
        F.when(created, F.initcap("country")).otherwise(F.col("_country")).alias("country"),
        F.when(created, F.initcap("region")).otherwise(F.col("_region")).alias("region"))
    new_rows = lookup.where("created").select(F.col("origin_id").alias("id"), "country", "region", "normalized_name")
    return lookup, insert_ignore(origins.select("id", "country", "region", "normalized_name"),
                                 new_rows, ["normalized_name"])


# ------------------------------------------------------------ similarity join

MIN_RATIO = LX.FUZZY_MIN_RATIO
TIERS = (0.96, 0.91, MIN_RATIO)     # a best match is looked for above each ratio in turn
MAX_SIGNATURES = 1000               # of one length, for one name


def _ratio(x: str, y: str) -> float:
    """``SequenceMatcher(None, x, y).ratio()``, or 0.0 when its cheap upper
    bounds already rule out ``> 0.85`` (``real_quick_ratio``, ``quick_ratio``)."""
    m = difflib.SequenceMatcher(None, x, y)
    if m.real_quick_ratio() <= MIN_RATIO or m.quick_ratio() <= MIN_RATIO:
        return 0.0
    return m.ratio()


def _make_ratio_batch(min_ratio: float):
    """The UDF body as a closure: pickled by value, so executors need no copy
    of this package (only difflib and pandas)."""
    import difflib as _difflib

    import pandas as _pd

    def ratio_batch(a, b):
        # Exact ratio per pair for the pairs that can pass the threshold.
        # SequenceMatcher indexes its second string once (set_seq2); pairs are
        # visited grouped by that string so one matcher serves them all and
        # only set_seq1 changes per pair -- the same ratio, far less work.
        out = [0.0] * len(a)
        xs, ys = a.tolist(), b.tolist()
        m = _difflib.SequenceMatcher(None)
        current = None
        for i in sorted(range(len(ys)), key=ys.__getitem__):
            y = ys[i]
            if y != current:
                m.set_seq2(y)
                current = y
            m.set_seq1(xs[i])
            if m.real_quick_ratio() > min_ratio and m.quick_ratio() > min_ratio:
                out[i] = m.ratio()
        return _pd.Series(out, dtype="float64")

    return ratio_batch


_ratio_batch = _make_ratio_batch(MIN_RATIO)
_RATIO_UDF = None


def sequence_ratio(a, b):
    """Column: the ratio of each (a, b) pair as a pandas UDF (created on first
    use); exact whenever the ratio exceeds 0.85, 0.0 for pairs ruled out."""
    global _RATIO_UDF
    if _RATIO_UDF is None:
        _RATIO_UDF = F.pandas_udf(_make_ratio_batch(MIN_RATIO), "double")
    return _RATIO_UDF(a, b)


def _bigrams(s):
    """Character bigrams of ``s`` in order (empty below two characters)."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))),
                        lambda i: F.substring(s, i, 2))
    return F.when(F.length(s) >= 2, grams).otherwise(F.array().cast("array<string>"))


def _tokens(grams):
    """Occurrence-numbered bigrams: 'ab#0', 'ab#1', ... (a multiset as a set).

    ``grams`` must be a column reference (see :func:`_bigrams`): the lambda
    reads it at every position and would otherwise rebuild it each time.
    """
    return F.transform(grams, lambda g, i: F.concat(
        g, F.lit("\u0001"), F.size(F.filter(F.slice(grams, 1, i), lambda x: x == g)).cast("string")))


def _prefix_len(n):
    """Bigram prefix length that cannot miss a partner with ratio > 0.85.

    A pair needs more than 0.275*(la+lb) - 1 shared bigrams and
    lb >= 0.739*la; the smallest such requirement t gives a prefix of
    (la - 1) - t + 1 bigrams (rounded so the filter only errs on the safe side).
    """
    lbmin = F.floor(n * 0.739)
    t = F.greatest(F.lit(1), F.ceil(F.lit(0.275) * (n + lbmin) - F.lit(1.0) - F.lit(1e-9)))
    return (n - 1) - t + 1


def _routes(left: Sequence[int], right: Sequence[int], min_ratio: float):
    """How names of the given lengths meet: the lengths of the signatures that a left and a right name of each length
    needs, and the lengths of left and right names that go by bigrams.

    A pair above ``min_ratio`` has a common subsequence of more than ``min_ratio * (la + lb) / 2`` characters,
    as matching blocks are one.
    """
    lw: dict[int, set[int]] = {}
    rw: dict[int, set[int]] = {}
    lg, rg = set(), set()
    for la in left:
        for lb in right:
            if 2.0 * min(la, lb) <= min_ratio * (la + lb):
                continue
            m = int(min_ratio * (la + lb) / 2.0)
            while 2.0 * m <= min_ratio * (la + lb):
                m += 1
            if max(math.comb(la, m), math.comb(lb, m)) <= MAX_SIGNATURES:
                lw.setdefault(la, set()).add(m)
                rw.setdefault(lb, set()).add(m)
            else:
                lg.add(la)
                rg.add(lb)
    return {n: sorted(m) for n, m in lw.items()}, {n: sorted(m) for n, m in rw.items()}, lg, rg


def _make_signed(text: str, wanted: dict[int, list[int]]):
    """The body of :func:`_signatures` as a closure (pickled by value)."""
    import itertools as _it

    import numpy as _np
    import pyarrow as _pa

    cells = 1 << 21

    def signed(batches):
        kept = {}
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            others = [i for i in range(batch.num_columns) if i != at]
            by_length = {}
            for i, t in enumerate(texts):
                if t is not None and len(t) in wanted:
                    by_length.setdefault(len(t), []).append(i)
            for n, rows in by_length.items():
                for m in wanted[n]:
                    if (n, m) not in kept:
                        kept[n, m] = _np.array(list(_it.combinations(range(n), m)), dtype=_np.intp)
                    places = kept[n, m]
                    step = max(1, cells // places.size)
                    for a in range(0, len(rows), step):
                        some = _np.array(rows[a:a + step])
                        codes = _np.array([[ord(c) for c in texts[i]] for i in some], dtype=_np.uint64)
                        h = _np.full((len(some), len(places)), 0xCBF29CE484222325 + m, dtype=_np.uint64)
                        for j in range(m):
                            h = (h ^ codes[:, places[:, j]]) * _np.uint64(0x9E3779B97F4A7C15)
                            h ^= h >> _np.uint64(29)
                        h.sort(axis=1)
                        new = _np.ones(h.shape, dtype=bool)
                        new[:, 1:] = h[:, 1:] != h[:, :-1]
                        whose = _pa.array(some[_np.nonzero(new)[0]])
                        yield _pa.RecordBatch.from_arrays(
                            [batch.column(i).take(whose) for i in others] + [_pa.array(h[new].view(_np.int64))],
                            [batch.schema.names[i] for i in others] + ["sig"])

    return signed


def _signatures(names: DataFrame, text: str, wanted: dict[int, list[int]]) -> DataFrame:
    """A row for each distinct signature of a name: its columns but ``text``, and ``sig``, a hash of a
    subsequence of one of the lengths that ``wanted`` gives for the name's length."""
    schema = StructType([f for f in names.schema if f.name != text] + [StructField("sig", LongType())])
    return _spread(names).mapInArrow(_make_signed(text, wanted), schema)


def _lengths(names: DataFrame, text: str) -> list[int]:
    """The lengths of at least two characters that occur."""
    return [r["n"] for r in names.select(F.length(text).alias("n")).where("n >= 2").distinct().collect()]


def similarity_candidates(left: DataFrame, right: DataFrame, block: str | None = None,
                          min_ratio: float = MIN_RATIO, lengths: tuple[list[int], list[int]] | None = None) -> DataFrame:
    """Pairs (lid, rid) that may have ratio(lstr, rstr) > ``min_ratio`` (0.85 at least).

    ``left``/``right``: (lid, lstr[, block]) / (rid, rstr[, block]).  Lossless: a pair above the ratio has a
    common subsequence of a length that the two lengths give, and each name is filed under the hashes of its
    subsequences of that length (itself less a few characters).  Where that would be more than ``MAX_SIGNATURES``
    for a name, names of these lengths meet by rare bigrams (:func:`_bigram_candidates`).  Of the lengths (found
    here where they are not given), only the distinct ones reach the driver.
    """
    bl = [block] if block else []
    lw, rw, lg, rg = _routes(*(lengths or (_lengths(left, "lstr"), _lengths(right, "rstr"))), min_ratio)
    lx = _signatures(left.select("lid", "lstr", *bl, F.length("lstr").alias("llen")), "lstr", lw)
    rx = _signatures(right.select("rid", "rstr", *bl, F.length("rstr").alias("rlen")), "rstr", rw)
    both = F.col("llen") + F.col("rlen")
    pairs = (lx.join(merging(rx), ["sig", *bl]).where(F.lit(2.0) * F.least("llen", "rlen") > F.lit(min_ratio) * both)
             .select("lid", "rid"))
    if lg:
        pairs = pairs.unionByName(_bigram_candidates(left.where(F.length("lstr").isin(sorted(lg))),
                                                     right.where(F.length("rstr").isin(sorted(rg))), block))
    return pairs.distinct()


def _bigram_candidates(left: DataFrame, right: DataFrame, block: str | None = None) -> DataFrame:
    """The same from bigrams.  Lossless: the prefix filter keeps, for each string, its rarest bigram tokens (global
    rarity over both sides); two strings with enough shared tokens must share
    one of them.  The length bound prunes before the UDF, which applies
    difflib's own upper bounds before the full ratio.
    """
    bl = [block] if block else []
    lt = left.select("lid", "lstr", *bl, F.length("lstr").alias("llen"))
    rt = right.select("rid", "rstr", *bl, F.length("rstr").alias("rlen"))
    lx = (lt.withColumn("_g", _bigrams(F.col("lstr")))
          .select("lid", "llen", *bl, F.explode_outer(_tokens(F.col("_g"))).alias("tok"))
          .where(F.col("tok").isNotNull()))
    rx = (rt.withColumn("_g", _bigrams(F.col("rstr")))
          .select("rid", "rlen", *bl, F.explode_outer(_tokens(F.col("_g"))).alias("tok"))
          .where(F.col("tok").isNotNull()))
    freq = (lx.select("tok").unionByName(rx.select("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("f")))

    def prefix(x, idc, lenc):
        w = Window.partitionBy(idc).orderBy("f", "tok")
        return (x.join(merging(freq), "tok").withColumn("_r", F.row_number().over(w))
                .where(F.col("_r") <= _prefix_len(F.col(lenc))).drop("_r", "f"))

    lp, rp = prefix(lx, "lid", "llen"), prefix(rx, "rid", "rlen")
    pairs = lp.join(merging(rp), ["tok", *bl]).select("lid", "rid", "llen", "rlen").distinct()
    return (pairs.where(F.lit(2.0) * F.least("llen", "rlen") > F.lit(MIN_RATIO) * (F.col("llen") + F.col("rlen")))
            .select("lid", "rid"))


def _enough_shared(a, b):
    """Column: strings ``a`` and ``b`` share as many bigrams as a ratio above the
    threshold needs (a multiset count, exact)."""
    need = F.lit(0.275) * (F.length(a) + F.length(b)) - F.lit(1.0)
    return F.size(F.array_intersect("_ltok", "_rtok")) > need


def _tokened(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn("_g", _bigrams(F.col(column))).withColumn(name, _tokens(F.col("_g"))).drop("_g")


def scored_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Candidate (lid, rid) pairs with the exact ``ratio`` above the threshold.

    ``left`` (lid, lstr) and ``right`` (rid, rstr) hold each string once.  Only
    pairs that pass the shared-bigram count reach the Python step.
    """
    joined = (pairs.join(merging(_tokened(left, "lstr", "_ltok")), "lid").join(merging(_tokened(right, "rstr", "_rtok")), "rid")
              .where(_enough_shared(F.col("lstr"), F.col("rstr"))).drop("_ltok", "_rtok"))
    return _spread(joined).withColumn("ratio", sequence_ratio(F.col("lstr"), F.col("rstr"))).where(F.col("ratio") > MIN_RATIO)


def _spread(rows: DataFrame) -> DataFrame:
    """Deal rows round-robin over the shuffle partitions before a Python step.
    Names and pairs are narrow rows, so AQE would otherwise
    coalesce them into a few large partitions and leave most cores idle
    during the (CPU-bound) step.  Round-robin is skew-free."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return rows.repartition(n)


def nearest(left: DataFrame, right: DataFrame, best: Column, block: str | None = None, earlier: bool = False,
            tiers: Sequence[float] = TIERS) -> DataFrame:
    """The best right name of each left one: (lid, b), for those that have one above the threshold.

    ``left``: lid, lstr, floor (a ratio the name has elsewhere: less is of no use), [block].  ``right``: rid, rstr,
    [block], and what ``best`` reads; ``earlier``: only rid < lid.  ``best`` folds a left name's pairs
    (with ``ratio``) to a struct that has the largest ``ratio``.

    In tiers: candidates above a high ratio hold every pair above it, so a name whose best is above it is done
    (nothing left out comes near that), and only the others look further off.  Tiers but the last are checkpointed.
    """
    bl = [block] if block else []
    done, right_lengths = [], _lengths(right, "rstr")
    for tier in tiers:
        lengths = _lengths(left, "lstr"), right_lengths
        if tier != tiers[-1] and not any(_routes(*lengths, tier)):
            continue                    # no two names are of lengths that can come near enough
        pairs = similarity_candidates(left, right, block, tier, lengths)
        if earlier:
            pairs = pairs.where(F.col("rid") < F.col("lid"))
        scored = scored_pairs(pairs, left.select("lid", "lstr"), right.select("rid", "rstr"))
        found = scored.join(merging(right.drop("rstr", *bl)), "rid").groupBy("lid").agg(best.alias("b"))
        if tier != tiers[-1]:
            found = found.where(F.col("b.ratio") > tier).checkpoint()
            left = left.where(F.col("floor") <= tier).join(merging(found.select("lid")), "lid", "left_anti").checkpoint()
        done.append(found)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def entity_cache(entities: DataFrame) -> DataFrame:
    """Lookup keys of existing entities: lower(name) and lower(slug).

    For a repeated key the last entity (id order, name before slug) is the
    value, while the key keeps the position of its first insertion (the order
    the fuzzy scan visits keys in, which breaks ties).
    """
    e = entities.select("id", "entity_type", F.posexplode(F.array(F.lower("name"), F.lower("slug"))).alias("p", "key"))
    e = e.where(F.col("key").isNotNull()).withColumn("_seq", F.struct("id", "p"))
    last = dedupe(e.select("key", "id", "entity_type", "_seq"), ["key"], ["_seq"], keep="last")
    first = e.groupBy("key").agg(F.min("_seq").alias("key_pos"))
    return last.drop("_seq").join(merging(first), "key").select(
        "key", F.col("id").alias("entity_id"), "entity_type",
        F.col("key_pos.id").alias("pos_id"), F.col("key_pos.p").alias("pos_p"))


def match_entities(probes: DataFrame, cache: DataFrame) -> DataFrame:
    """Exact (any type) then best fuzzy match (same type, ratio > 0.85).

    ``probes``: (probe_id, name, entity_type); returns (probe_id, entity_id,
    method, ratio) for matched probes only.  Names are resolved once each,
    however often they are mentioned, and joined back to the mentions.
    """
    checkpoint_root(probes.sparkSession)
    p = probes.select("probe_id", "entity_type", T.normalize_name("name").alias("norm"))
    names = p.select("entity_type", "norm").distinct().checkpoint()
    cache = cache.checkpoint()
    exact = names.join(merging(cache.select(F.col("key").alias("norm"), "entity_id")), "norm") \
        .select("entity_type", "norm", "entity_id", F.lit("exact").alias("method"), F.lit(1.0).alias("ratio"))
    keys = cache.select("key", "entity_type", "entity_id", "pos_id", "pos_p")
    rest = names.join(merging(keys.select(F.col("key").alias("norm"))), "norm", "left_anti")
    # a probe type and its name are one string here, so that the pair has one id
    left = rest.select(F.concat_ws("\u0002", "entity_type", "norm").alias("lid"), F.col("norm").alias("lstr"),
                       F.col("entity_type").alias("blk"), F.lit(0.0).alias("floor")).checkpoint()
    right = keys.select(F.col("key").alias("rid"), F.col("key").alias("rstr"), F.col("entity_type").alias("blk"),
                        "entity_id", "pos_id", "pos_p")
    best = nearest(left, right, F.max_by(F.struct("entity_id", "ratio"),
                                         F.struct(F.col("ratio"), -F.col("pos_id"), -F.col("pos_p"))), block="blk")
    fuzzy = best.join(merging(left.select("lid", F.col("blk").alias("entity_type"), F.col("lstr").alias("norm"))), "lid").select(
        "entity_type", "norm", F.col("b.entity_id").alias("entity_id"), F.lit("fuzzy").alias("method"),
        F.col("b.ratio").alias("ratio"))
    return (p.join(merging(exact.unionByName(fuzzy)), ["entity_type", "norm"])
            .select("probe_id", "entity_id", "method", "ratio"))


# ------------------------------------------------------------ creation rounds


def _earlier_pairs(left: DataFrame, right: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """(lid, rid): the pairs of names (id, text) above the threshold whose right one is earlier."""
    lt = left.select(F.col("id").alias("lid"), F.col("text").alias("lstr"))
    rt = right.select(F.col("id").alias("rid"), F.col("text").alias("rstr"))
    lengths = _lengths(lt, "lstr"), _lengths(rt, "rstr")
    if not any(_routes(*lengths, min_ratio)):
        return lt.join(merging(rt), F.col("lid") == F.col("rid")).select("lid", "rid").limit(0)
    pairs = similarity_candidates(lt, rt, min_ratio=min_ratio, lengths=lengths).where(F.col("rid") < F.col("lid"))
    return scored_pairs(pairs, lt, rt).select("lid", "rid").checkpoint()


def _leaders(names: DataFrame) -> DataFrame:
    """The ids of the names (id, text) that are near no earlier leader.

    A name is settled as a follower by one earlier leader, and mostly a very near one tells it.  So all pairs
    are made only among the names ``asked``: at first those without a very near earlier name.  The names left out
    that then have no very near earlier leader are asked too, until each of the rest has one: the leaders among
    the asked are the leaders of all.  The fourth time all names are asked.
    """
    close = _earlier_pairs(names, names, TIERS[0])
    near_one = merging(close.select(F.col("lid").alias("id")).distinct())
    asked, rest = names.join(near_one, "id", "left_anti").checkpoint(), names.join(near_one, "id", "left_semi").checkpoint()
    edges = _earlier_pairs(asked, asked)
    for turn in range(4):
        leaders = _rounds(asked.select("id"), edges)
        told = close.join(merging(leaders.select(F.col("id").alias("rid"))), "rid", "left_semi").select(F.col("lid").alias("id")).distinct()
        unsettled = rest.join(merging(told), "id", "left_anti")
        if turn == 3 or not unsettled.limit(1).count():
            break
        missed = (unsettled if turn < 2 else rest).checkpoint()
        edges = edges.unionByName(_earlier_pairs(missed, asked)).unionByName(_earlier_pairs(asked, missed)) \
            .unionByName(_earlier_pairs(missed, missed)).checkpoint()
        asked = asked.unionByName(missed).checkpoint()
        rest = rest.join(merging(missed.select("id")), "id", "left_anti").checkpoint()
    return leaders


def _rounds(undecided: DataFrame, edges: DataFrame) -> DataFrame:
    """The leaders among the names ``undecided`` (id): names of no edge (lid, rid) to an earlier leader."""
    undecided, waiting = undecided.checkpoint(), edges       # the edges of undecided names
    found = [undecided.limit(0)]
    while undecided.limit(1).count():
        open_id = undecided.select(F.col("id").alias("rid"))
        blocked = waiting.join(merging(open_id), "rid", "left_semi").select(F.col("lid").alias("id")).distinct()
        leaders = undecided.join(merging(blocked), "id", "left_anti").checkpoint()
        lead_id = leaders.select(F.col("id").alias("rid"))
        followers = waiting.join(merging(lead_id), "rid", "left_semi").select(F.col("lid").alias("id")).distinct()
        found.append(leaders)
        undecided = undecided.join(merging(leaders.unionByName(followers)), "id", "left_anti").checkpoint()
        waiting = waiting.join(merging(undecided.select(F.col("id").alias("lid"))), "lid", "left_semi").checkpoint()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.checkpoint()


def create_entities(probes: DataFrame, entities: DataFrame, entity_type: str = "roaster") -> DataFrame:
    """Sequential find-or-create semantics, computed in parallel rounds.

    ``probes``: (probe_id, seq, name) in processing order (``seq``: any type that
    orders, for example a struct of review and position).  Each name, in
    order, takes an exact key match (any type), else the best same-type match
    among the existing keys and the entities created before it (ratio > 0.85;
    ties: existing keys first, then the earliest created), else becomes a new
    entity whose normalised name is a key for the names after it.

    Rounds over the similarity graph of the unmatched names (edges point to
    earlier names): a name with an earlier *leader* neighbour, or any existing
    match, is a follower; a name whose earlier neighbours are all followers is
    a leader.  A clique resolves in two rounds; each round decides at least the
    earliest undecided name, and the rounds go on until none is left.  A
    round's state and the edges of the names still open are checkpointed
    (lineage cut in the shared checkpoint folder).  Pairs are made where they decide something (:func:`_leaders`).
    Followers then pick their best target (:func:`nearest`).  New entity ids follow the
    slug of the leader's first name (an existing slug keeps its id).
    Returns (probe_id, seq, name, entity_id, method).
    """
    spark = probes.sparkSession
    checkpoint_root(spark)
    cache = entity_cache(entities)
    typed = probes.select("probe_id", "seq", "name", F.lit(entity_type).alias("entity_type"))
    matched = match_entities(typed, cache)
    p = typed.select("probe_id", "seq", "name", T.normalize_name("name").alias("norm"))
    first = p.groupBy("norm").agg(F.min("seq").alias("nseq"), F.min_by("name", "seq").alias("first_name"))
    ex = (p.join(merging(matched), "probe_id").groupBy("norm")
          .agg(F.min_by(F.struct("entity_id", "method", "ratio"), "seq").alias("m")))
    names = first.join(merging(ex), "norm", "left").select(
        "norm", "nseq", "first_name", F.col("m.entity_id").alias("ex_id"),
        F.col("m.method").alias("ex_method"), F.col("m.ratio").alias("ex_ratio")).checkpoint()
    open_names = names.where(F.col("ex_method").isNull() | (F.col("ex_method") != "exact"))
    # only a name without any existing match can become a leader (a target)
    may_lead = open_names.where(F.col("ex_id").isNull()).select(F.col("nseq").alias("id"), F.col("norm").alias("text")).checkpoint()
    leaders = _leaders(may_lead).checkpoint()
    state = (open_names.select(F.col("nseq").alias("id"))
             .join(merging(leaders.select("id", F.lit("leader").alias("status"))), "id", "left")
             .withColumn("status", F.coalesce("status", F.lit("follower"))))
    # entity id of each leader: its first name's slug; an existing slug keeps its id
    slugs = entities.select(F.lower("slug").alias("slug"), F.col("id").alias("slug_id"))
    lead = (leaders.join(merging(names.select(F.col("nseq").alias("id"), "first_name", "norm")), "id")
            .withColumn("slug", T.slugify("first_name"))
            .join(merging(slugs), "slug", "left")
            .select(F.col("id").alias("rid"), F.col("norm").alias("rstr"),
                    F.coalesce("slug_id", F.xxhash64("slug")).alias("lead_id"))).checkpoint()
    # follower targets: existing match (scanned first) or the best earlier leader
    first_place = F.lit(None).cast(names.schema["nseq"].dataType)
    follow = (open_names.join(merging(leaders.select(F.col("id").alias("nseq"))), "nseq", "left_anti")
              .select(F.col("nseq").alias("lid"), F.col("norm").alias("lstr"), F.coalesce("ex_ratio", F.lit(0.0)).alias("floor"))
              .checkpoint())
    # the best earlier leader; of equal ratios the earliest
    near = nearest(follow, lead, F.min_by(F.struct("lead_id", "ratio", "rid"), F.struct(-F.col("ratio"), F.col("rid"))),
                   earlier=True)
    opts = (near.select(F.col("lid").alias("id"), F.col("b.ratio").alias("ratio"), F.lit(1).alias("prio"),
                        F.col("b.rid").alias("order"), F.col("b.lead_id").alias("target"))
            .unionByName(names.where(F.col("ex_method") == "fuzzy").select(
                F.col("nseq").alias("id"), F.col("ex_ratio").alias("ratio"), F.lit(0).alias("prio"),
                first_place.alias("order"), F.col("ex_id").alias("target"))))
    best = opts.groupBy("id").agg(F.min_by("target", F.struct(-F.col("ratio"), "prio", "order")).alias("target"))
    decided = (state.join(merging(best), "id", "left")
               .join(merging(lead.select(F.col("rid").alias("id"), "lead_id")), "id", "left")
               .select(F.col("id").alias("nseq"),
                       F.when(F.col("status") == "leader", F.col("lead_id")).otherwise(F.col("target")).alias("eid"),
                       F.when(F.col("status") == "leader", F.lit("created")).otherwise(F.lit("fuzzy")).alias("how")))
    out = p.join(merging(names.select("norm", "nseq", "ex_id", "ex_method")), "norm").join(merging(decided), "nseq", "left")
    return out.select(
        "probe_id", "seq", "name",
        F.when(F.col("ex_method") == "exact", F.col("ex_id")).otherwise(F.col("eid")).alias("entity_id"),
        F.when(F.col("ex_method") == "exact", F.lit("exact")).otherwise(F.col("how")).alias("method"))
