"""Periodic runs in documents: stretches of words that repeat with some period.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), of at least ``max(MIN_LENGTH, 2 * q)`` words, that no neighbouring
word extends.

Method.  Every octave of periods P .. 2P-1 has its own tiling: a document is
exploded into tiles that overlap by at least two of the longest periods, so
each run has a stretch of two periods inside some tile, and two tiles that
see one run share at least a period of it.  A tile is solved without its
neighbours.  Boundaries stand every P/4 words; any P equal words q apart hold
three blocks between boundaries, so a boundary c and a period q are only of
interest if the 3P/4 words after c equal those after c + q (compared by block
hashes, many boundaries at a time).  There the Z function at the boundary,
forwards and backwards, gives the stretch, word by word.  Stretches are
fragments: they shuffle by (document, period), and fragments that share a
period or more are stitched to runs by a window.

The text of a document is read in one task, as a row is; tiles are gathered
in groups of bounded size, so the memory of a task is bounded by its longest
text.  The shuffle carries fragments; texts travel only for documents that
have one.  Equal words have equal hashes, so no run is lost by hashing;
fragments are compared again by their words.

Defined cases: null and empty texts have no words and no runs; documents are
told apart by id and word sequence, so rows that repeat both have the same
result, and equal or null ids with other words are documents of their own; an
empty table gives no rows; columns besides doc_id and text are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brewlens.llm import words as W
from brewlens.llm.common import crc_of_id, prepare, written

MIN_LENGTH = 12
TILE_WORDS = 1 << 15       # words of a tile's own part, or four of the octave's periods
GROUP_WORDS = 1 << 20      # words of the tiles solved together
SMALL = 8                  # periods below are compared word by word
CELLS = 1 << 22            # comparisons at a time
U = np.uint64
SPACE = " \t\n\x0b\x0c\r"


# ----------------------------------------------------------------------------- tiles
def tile_bounds(counts: np.ndarray, body: int, overlap: int):
    """(document, start, end) of every tile; a document of up to body + overlap words is one tile."""
    tiles = np.maximum(1, -(-(counts - overlap) // body))
    doc = np.repeat(np.arange(len(counts)), tiles)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
    start = number * body
    return doc, start, np.minimum(start + body + overlap, counts[doc])


def _blocks(tile: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) words from every place."""
    h, have = tile, 1
    while have < size and len(h) > have:
        h = h[:-have] * U(0x9E3779B97F4A7C15) + (h[have:] ^ (h[have:] >> U(31))) * U(0xBF58476D1CE4E5B9)
        have *= 2
    return h if have == size else h[:0]


def _smallest_factor(n: int) -> np.ndarray:
    factor = np.arange(n + 1)
    for p in range(2, int(n ** 0.5) + 1):
        if factor[p] == p:
            rest = factor[p * p::p]
            rest[rest == np.arange(p * p, n + 1, p)] = p
    return factor


def _stretches(places: np.ndarray):
    """Runs of consecutive numbers: (first, one past the last)."""
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate(([0], cut + 1))], places[np.concatenate((cut, [len(places) - 1]))] + 1


def _z(tile: np.ndarray, a: int, b: int) -> int:
    """How many words from a on equal those from b on (a < b)."""
    got, size = 0, 64
    while b + got < len(tile):
        y = tile[b + got:b + got + size]
        differ = tile[a + got:a + got + len(y)] != y
        if differ.any():
            return got + int(differ.argmax())
        got, size = got + len(y), size * 2
    return got


def _z_back(tile: np.ndarray, a: int, b: int) -> int:
    """How many words before a equal those before b (a < b)."""
    got, size = 0, 64
    while got < a:
        n = min(size, a - got)
        differ = (tile[a - got - n:a - got] != tile[b - got - n:b - got])[::-1]
        if differ.any():
            return got + int(differ.argmax())
        got, size = got + n, size * 2
    return got


def _small_periods(tile: np.ndarray):
    """(period, start, end) for the periods below SMALL."""
    out, seen = [], {}
    for q in range(1, min(SMALL, len(tile))):
        places = np.flatnonzero(tile[:-q] == tile[q:])
        if not len(places):
            continue
        first, last = _stretches(places)
        long = last - first >= max(MIN_LENGTH - q, q)
        for s, e in zip(first[long].tolist(), (last[long] + q).tolist()):
            # a stretch that a divisor of q repeats as well has the same two ends
            if not any(q % d == 0 for d in seen.get((s, e), ())):
                seen.setdefault((s, e), []).append(q)
                out.append((q, s, e))
    return out


def _candidates(tile: np.ndarray, low: int):
    """(boundary, period) where the blocks after the boundary repeat a primitive period later."""
    step = low // 4
    b = _blocks(tile, step)
    if len(b) <= 2 * step:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    g = W.combine([b[:len(b) - 2 * step], b[step:len(b) - step], b[2 * step:]], 1)
    at = np.arange(0, max(0, len(g) - low), step)
    padded = np.concatenate([g, np.zeros(2 * low, U)])
    later = np.lib.stride_tricks.sliding_window_view(padded[low:], low)
    found_c, found_q = [], []
    for a in range(0, len(at), max(1, CELLS // low)):
        c = at[a:a + max(1, CELLS // low)]
        row, col = np.nonzero(later[c[0]:c[-1] + 1:step] == g[c][:, None])
        inside = c[row] + low + col < len(g)
        found_c.append(c[row[inside]])
        found_q.append(low + col[inside])
    if not found_c:
        return at, at
    c, q = np.concatenate(found_c), np.concatenate(found_q)
    if not len(c):
        return c, q
    # drop a period that a smaller one divides: the words of [c, c + q) repeat after q / prime
    pair, width = _blocks(tile, 2 * step), 2 * step
    factor, rest, repeats = _smallest_factor(2 * low), q.copy(), np.zeros(len(c), bool)
    while (rest > 1).any():
        p = factor[rest]
        some = np.flatnonzero(rest > 1)
        d = q[some] // p[some]
        m = q[some] - d
        same = np.ones(len(some), bool)
        for k in range(4):
            x = c[some] + np.minimum(k * width, m - width)
            same &= pair[x] == pair[x + d]
        repeats[some] |= same
        rest = np.where(rest > 1, rest // np.maximum(p, 1), rest)
    return c[~repeats], q[~repeats]


def solve_tile(tile: np.ndarray, low: int):
    """Maximal stretches (period, start, end) of the octave ``low`` in an array of word hashes."""
    if low < SMALL:
        return _small_periods(tile)
    c, q = _candidates(tile, low)
    out, done_q, done = [], -1, -1
    order = np.lexsort((c, q))
    for at, period in zip(c[order].tolist(), q[order].tolist()):
        if period == done_q and at < done:       # the last stretch of this period holds it
            continue
        start, end = at - _z_back(tile, at, at + period), at + _z(tile, at, at + period)
        done_q, done = period, end
        if end - start >= period:
            out.append((period, start, end + period))
    return out


def octaves(longest: int):
    """(first period, overlap) of the octaves; the periods below SMALL make the first."""
    low = 1
    while max(MIN_LENGTH, 2 * low) <= longest:
        yield low, max(MIN_LENGTH, 2 * SMALL if low < SMALL else 4 * low)
        low = SMALL if low < SMALL else low * 2


def fragments(ids: np.ndarray, counts: np.ndarray, tile_words: int = TILE_WORDS):
    """Per document a list of (period, start, end), one for each tile that sees the run.

    ``ids`` holds the words of all documents in a row, ``counts`` the words of each.
    """
    first = np.cumsum(counts) - counts
    out: list[list] = [[] for _ in counts]
    for low, overlap in octaves(int(counts.max(initial=0))):
        chosen = np.flatnonzero(counts >= max(MIN_LENGTH, 2 * low))
        doc, start, end = tile_bounds(counts[chosen], max(tile_words, 4 * low), overlap)
        doc, sizes = chosen[doc], end - start
        group = np.cumsum(sizes) // GROUP_WORDS
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(doc)]
        for a, b in zip(edges, edges[1:]):
            n, base = sizes[a:b], np.cumsum(sizes[a:b]) - sizes[a:b]
            take = np.arange(int(n.sum())) + np.repeat(first[doc[a:b]] + start[a:b] - base, n)
            # words of different tiles never equal each other
            salt = np.repeat(np.arange(b - a, dtype=U) * U(0xD6E8FEB86659FD93), n)
            for period, s, e in solve_tile(ids[take] + salt, low):
                t = int(np.searchsorted(base, s, "right")) - 1
                shift = int(start[a + t] - base[t])
                out[doc[a + t]].append((period, s + shift, e + shift))
    return out


# ----------------------------------------------------------------------------- Spark
FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _confirmed(found, split: list[bytes], tile_words: int):
    """The fragments; a document where word hashes collided is solved again on its own numbering of words."""
    if all(split[s:e - q] == split[s + q:e] for q, s, e in found):
        return found
    number: dict = {}
    ids = W.mix(np.array([number.setdefault(w, len(number)) for w in split], U) + U(1))
    return fragments(ids, np.array([len(split)]), tile_words)[0]


def tile_fragments(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """doc_id, n_words, words_sha256 (of all words joined by one space), fragments; words (joined) where there are any."""
    prepare(docs.sparkSession)
    id_field = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in W.slices(batch):
                texts = part.column("text")
                w = W.words(texts)
                counts = np.bincount(w.doc, minlength=len(texts))
                found = fragments(w.hash, counts, tile_words)
                n, sha, pieces, joined = [], [], [], []
                for text, runs in zip(texts, found):
                    split = (text.as_py() or "").encode().split()
                    plain = b" ".join(split)
                    n.append(len(split))
                    sha.append(hashlib.sha256(plain).hexdigest())
                    runs = _confirmed(runs, split, tile_words)
                    pieces.append([dict(zip(("period", "start", "end"), r)) for r in runs])
                    joined.append(plain.decode() if runs else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                     pa.array(pieces, pa.list_(FRAGMENT)), pa.array(joined, pa.string())],
                    ["doc_id", "n_words", "words_sha256", "fragments", "words"])

    schema = (f"doc_id {id_field}, n_words long, words_sha256 string, "
              "fragments array<struct<period:long,start:long,end:long>>, words string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def stitch(pieces: DataFrame) -> DataFrame:
    """Runs (doc_id, words_sha256, start, length, period) of the fragments: those of one document
    and period that share a period or more are one run."""
    key = ["doc_id", "words_sha256", "period"]
    each = pieces.select("doc_id", "words_sha256", F.inline("fragments"))
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    told = each.withColumn("reached", F.max("end").over(before))
    told = told.withColumn("fresh", F.when(F.col("start") <= F.col("reached") - F.col("period"), 0).otherwise(1))
    told = told.withColumn("run_no", F.sum("fresh").over(Window.partitionBy(*key).orderBy("start", "end")
                                                         .rowsBetween(Window.unboundedPreceding, 0)))
    runs = told.groupBy(*key, "run_no").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.select("doc_id", "words_sha256", "start", (F.col("end") - F.col("start")).alias("length"), "period")
    return runs.filter((F.col("length") >= MIN_LENGTH) & (F.col("length") >= 2 * F.col("period")))


def collapse(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed_text and collapsed_sha256
    of every row.

    The collapsed text has the words that no run holds beyond its first period, joined by one
    space; it is null where nothing is dropped, the digest is that of all words then.
    """
    pieces = written(tile_fragments(docs, tile_words), "run-fragments")
    runs = stitch(pieces).groupBy("doc_id", "words_sha256").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("run_id"), F.col("words_sha256").alias("run_sha"), "runs")
    joined = pieces.drop("fragments").join(
        runs, F.col("doc_id").eqNullSafe(F.col("run_id")) & (F.col("words_sha256") == F.col("run_sha")), "left")
    id_field = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, digests = [], []
            for words, found, plain in zip(batch.column("words"), batch.column("runs"), batch.column("words_sha256")):
                found, text, digest = found.as_py() or [], None, plain.as_py()
                if found:
                    split = words.as_py().split(" ")
                    change = np.zeros(len(split) + 1, np.int64)
                    np.add.at(change, [r["start"] + r["period"] for r in found], 1)
                    np.add.at(change, [r["start"] + r["length"] for r in found], -1)
                    text = " ".join(w for w, inside in zip(split, np.cumsum(change).tolist()) if not inside)
                    digest = hashlib.sha256(text.encode()).hexdigest()
                texts.append(text)
                digests.append(digest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), batch.column("runs"),
                 pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed_text", "collapsed_sha256"])

    return joined.select("doc_id", "n_words", "words_sha256", "words", "runs").mapInArrow(
        run, f"doc_id {id_field}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
             "collapsed_text string, collapsed_sha256 string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeats some of its words to its end.

    With h the crc32 of the id and g = floor(h / 10): if 10 divides h, word i >= a becomes word
    a + (i - a) % p, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    body = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACE))
    split = F.when((crc_of_id(F.col("doc_id")) % 10 == 0) & (body != ""), F.split(body, r"[\x20\x09-\x0D]+"))
    step = docs.select("doc_id", "text", split.alias("w"), F.floor(crc_of_id(F.col("doc_id")) / 10).alias("g"))
    step = step.select("doc_id", "text", "w", "g", F.pmod(F.col("g"), F.size("w")).alias("a"))
    step = step.select("doc_id", "text", "w", "a", (F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8)) + 1).alias("p"))
    told = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p AS int)])), ' ')")
    return step.select("doc_id", F.when(F.col("w").isNotNull(), told).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """doc_id, n_words, n_runs, the longest run and the digests, one row per document."""
    found = collapse(docs, tile_words).withColumn("runs", F.coalesce("runs", F.expr(
        "cast(array() AS array<struct<start:long,length:long,period:long>>)")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                                 r["period"].alias("period"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                               F.lit("\n"))), "")
    found = found.withColumn("longest", longest)
    length, period = -F.col("longest.less"), F.col("longest.period")
    return found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
                        F.col("longest.start").alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
                        F.sha2(told, 256).alias("runs_sha256"), "collapsed_sha256")
