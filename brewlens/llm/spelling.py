"""Spelling variants: words one edit apart, and for each the much more frequent form.

Method.  The vocabulary (words of at least MIN_LETTERS letters and MIN_COUNT
occurrences) is counted with the counts folded in each task first.  It is put
into blocked Bloom filters, one for each word length, which are broadcast.
Each word then generates its neighbourhood (every letter replaced, every letter
left out) as hashes only, and probes the filter of that length.  A positive
becomes a string and shuffles to an exact join with the vocabulary, which
removes the false ones.  An inserted letter is a letter left out of the other
word, so those pairs are turned round.

The filters have at most FILTER_BYTES in all: a vocabulary beyond that makes
them less selective, never wrong, so the broadcast has a bound and the result
does not depend on it.  They are built by OR-ing masks per block in a grouped
aggregation.  Words longer than LONGEST_SHARD letters share a filter.

``root`` follows the forms to the last by doubling self-joins until nothing
changes; counts grow at each step, so there are no circles.

Defined cases: null and empty texts have no words; rows that repeat count again;
a null id counts as the text '' in the deletion rule; words of any length
are probed in blocks of bounded size; equal counts go to the smaller word in
code-point order; an empty table gives no rows; columns besides doc_id and
text are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm import words as W
from brewlens.llm.common import prepare, shuffle_partitions, written

MIN_LETTERS = 6
MIN_COUNT = 5
FREQUENT = 5                # a form occurs at least so many times as often
DELETE_EVERY = 199          # the query's edit: crc32s that this divides lose a letter
FILTER_BYTES = 16 << 20     # of all filters
KEY_BITS = 24               # per word, as long as that fits
LANES = 8                   # 32-bit words of a block; a word sets one bit in each
LONGEST_SHARD = 64
PROBES = 1 << 20            # probes at a time
FLUSH_WORDS = 200_000       # distinct words a task holds before it passes its counts on
U = np.uint64

LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)
SALTS = W.mix(np.arange(1, LANES + 1)) >> U(32) | U(1)      # odd multipliers, one for each lane
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


# ----------------------------------------------------------------------------- counting
def _edited(run: str, digest: int) -> str:
    if digest % DELETE_EVERY:
        return run
    at = digest % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lower-cased, counted over all texts after the deletion rule."""
    prepare(docs.sparkSession)

    def run(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = text.as_py()
                if not raw:
                    continue
                # short runs stay short whatever the rule does, so they are never looked at
                runs = Counter(_RUN.findall(raw.encode().translate(_LOWER).decode()))
                start = zlib.crc32(b"%s:" % str("" if doc_id is None else doc_id).encode())
                for word, n in runs.items():
                    digest = zlib.crc32(word.encode(), start)
                    if not digest % DELETE_EVERY:
                        word = _edited(word, digest)
                        if len(word) < MIN_LETTERS:
                            continue
                    held[word] += n
                if len(held) > FLUSH_WORDS:
                    yield flush()
        if held:
            yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# ----------------------------------------------------------------------------- filters
def place_values(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """A random value for a letter (its number in LETTERS) at a place; a word's hash is their sum."""
    return W.mix(place.astype(U) * U(0x9E3779B97F4A7C15) + letter.astype(U) + U(1))


def _finish(total: np.ndarray, letters: int) -> np.ndarray:
    return W.mix(total + U(letters * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))


def _shard(letters: int) -> int:
    return min(letters, LONGEST_SHARD)


def _block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> U(32)) * U(blocks) >> U(32)).astype(np.int64)


def _bit(h: np.ndarray, lane: int) -> np.ndarray:
    return ((h & U(0xFFFFFFFF)) * SALTS[lane] & U(0xFFFFFFFF)) >> U(27)


def _coded(words: list[str]) -> np.ndarray:
    """Letter numbers of words of one length, one row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int64)
    return np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26)


def _by_length(words: list[str]):
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by.setdefault(len(w), []).append(k)
    return by.items()


def filter_blocks(vocab: DataFrame, budget: int = FILTER_BYTES) -> dict[int, int]:
    """Blocks of the filter of each length, within ``budget`` bytes (a block each at least)."""
    sizes = vocab.groupBy(F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r["shard"]: r["n"] for r in sizes.collect()}          # at most LONGEST_SHARD rows
    bits = min(KEY_BITS, budget * 8 / max(1, sum(counts.values())))
    return {shard: max(1, int(n * bits) // (32 * LANES)) for shard, n in counts.items()}


def build_filters(vocab: DataFrame, budget: int = FILTER_BYTES) -> dict[int, np.ndarray]:
    """Filter of each length: an array (blocks, LANES) of 32-bit words, of bounded size."""
    blocks = filter_blocks(vocab, budget)

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            out = [[], [], *([] for _ in range(LANES))]
            for letters, rows in _by_length(words):
                codes = _coded([words[k] for k in rows])
                h = _finish(place_values(np.broadcast_to(np.arange(letters), codes.shape), codes).sum(axis=1, dtype=U), letters)
                out[0].append(np.full(len(rows), _shard(letters), np.int32))
                out[1].append(_block_of(h, blocks[_shard(letters)]))
                for lane in range(LANES):
                    out[2 + lane].append((U(1) << _bit(h, lane)).astype(np.int64))
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                                 ["shard", "block", *(f"m{k}" for k in range(LANES))])

    masks = vocab.select("word").mapInArrow(run, "shard int, block long, " + ", ".join(f"m{k} long" for k in range(LANES)))
    found = masks.groupBy("shard", "block").agg(*[F.bit_or(f"m{k}").alias(f"m{k}") for k in range(LANES)]).toArrow()
    filters = {shard: np.zeros((n, LANES), np.uint32) for shard, n in blocks.items()}
    shards, places = found.column("shard").to_numpy(), found.column("block").to_numpy()
    values = np.stack([found.column(f"m{k}").to_numpy().astype(np.uint32) for k in range(LANES)], axis=1) if len(shards) else None
    for shard in filters:
        mine = shards == shard
        filters[shard][places[mine]] = values[mine]
    return filters


def probe(filters: dict[int, np.ndarray], h: np.ndarray, letters: int) -> np.ndarray:
    """Places in ``h`` of the hashes that the filter of that length holds."""
    table = filters.get(_shard(letters))
    if table is None:
        return np.zeros(0, np.int64)
    left = np.arange(len(h))
    block = _block_of(h, len(table))
    for lane in range(LANES):
        hit = (table[block, lane] >> _bit(h[left], lane).astype(np.uint32)) & 1 == 1
        left, block = left[hit], block[hit]
    return left


def generated(words: list[str], filters: dict[int, np.ndarray]):
    """(row, probe, deleted) of every edit of the words that the filters let through."""
    size = len(LETTERS)
    for letters, rows in _by_length(words):
        chunk = max(1, PROBES // (letters * size))
        for a in range(0, len(rows), chunk):
            some = rows[a:a + chunk]
            codes = _coded([words[k] for k in some])
            place = np.arange(letters)
            own = place_values(np.broadcast_to(place, codes.shape), codes)
            total = own.sum(axis=1, dtype=U)
            # letters at a time, so that one very long word is bounded as well
            span = max(1, PROBES // (len(some) * size))
            for at in range(0, letters, span):
                here = np.arange(at, min(at + span, letters))
                other = place_values(np.repeat(here, size), np.tile(np.arange(size), len(here))).reshape(len(here), size)
                h = (total[:, None] - own[:, here])[:, :, None] + other[None]
                hits = probe(filters, _finish(h.ravel(), letters), letters)
                who, where, letter = np.unravel_index(hits, h.shape)
                for i, j, c in zip(who.tolist(), here[where].tolist(), letter.tolist()):
                    if codes[i, j] != c:
                        w = words[some[i]]
                        yield some[i], w[:j] + chr(LETTERS[c]) + w[j + 1:], False
            if letters <= MIN_LETTERS:
                continue
            # what follows the letter left out moves one place to the left
            moved = np.zeros_like(own)
            moved[:, 1:] = place_values(np.broadcast_to(place[:-1], codes[:, 1:].shape), codes[:, 1:])
            before = np.cumsum(own, axis=1, dtype=U) - own
            after = moved.sum(axis=1, dtype=U)[:, None] - np.cumsum(moved, axis=1, dtype=U)
            hits = probe(filters, _finish((before + after).ravel(), letters - 1), letters - 1)
            for i, j in zip((hits // letters).tolist(), (hits % letters).tolist()):
                if j + 1 == letters or codes[i, j] != codes[i, j + 1]:      # of equal letters in a row the last
                    w = words[some[i]]
                    yield some[i], w[:j] + w[j + 1:], True


# ----------------------------------------------------------------------------- Spark
def near_pairs(vocab: DataFrame, budget: int = FILTER_BYTES) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, both ways round.  ``vocab`` is a written table."""
    spark = vocab.sparkSession
    filters = spark.sparkContext.broadcast({k: v.tobytes() for k, v in build_filters(vocab, budget).items()})

    def run(batches):
        tables = {k: np.frombuffer(v, np.uint32).reshape(-1, LANES) for k, v in filters.value.items()}
        for batch in batches:
            words = batch.column("word").to_pylist()
            rows, probes, deleted = [], [], []

            def held():
                taken = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column("word").take(taken), batch.column("n").take(taken), pa.array(probes, pa.string()),
                     pa.array(deleted, pa.bool_())], ["word", "n", "probe", "deleted"])

            for row, text, gone in generated(words, tables):
                rows.append(row)
                probes.append(text)
                deleted.append(gone)
                if len(rows) >= 50_000:
                    yield held()
                    rows, probes, deleted = [], [], []
            if rows:
                yield held()

    dealt = vocab.repartition(shuffle_partitions(spark), "word")
    positives = dealt.mapInArrow(run, "word string, n long, probe string, deleted boolean")
    exact = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = written(positives.join(exact, positives["probe"] == exact["near"]).select("word", "n", "near", "near_n", "deleted"),
                    "near-pairs")
    filters.destroy()
    turned = found.filter("deleted").select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.select("word", "near", "near_n").unionByName(turned)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: the form's form and so on to the last."""
    reach = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reach.select(F.col("word").alias("mid"), F.col("root").alias("far"))
        if not reach.join(further, reach["root"] == further["mid"], "left_semi").limit(1).count():
            return reach
        reach = written(reach.join(further, reach["root"] == further["mid"], "left")
                        .select("word", F.coalesce("far", "root").alias("root")), "roots")


def variants(docs: DataFrame, budget: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    vocab = written(vocabulary(docs), "vocabulary")
    near = near_pairs(vocab, budget).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    told = vocab.join(near, "word", "left")
    frequent = -F.col("best.less") >= FREQUENT * F.col("n")
    told = written(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(frequent, F.col("best.near")).alias("form"),
                               F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    reach = roots(told.filter("form IS NOT NULL")).select(F.col("word").alias("rooted"), "root")
    return (told.join(reach, told["word"] == reach["rooted"], "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
