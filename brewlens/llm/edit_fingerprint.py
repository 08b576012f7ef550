"""Fingerprints of whole texts by a randomised edit embedding.

Method.  A walk reads a text character by character: at each step it writes
the character it stands on, and a random bit shared by all texts (of the step
and the character) says whether it moves on.  Two texts that differ by few
edits fall into step again soon after each edit, so their edit distance shows
as the Hamming distance of what they wrote.  The fingerprint samples that
sequence at places shared by all texts: the first 64 steps and SAMPLES places
of every octave of steps, a hex digit for the character there and the two
before.  It is a string ``<steps in hex>:<digits>``.

``likeness`` estimates the share of equal steps: octaves count by their
length, chance agreement (1 in 16) is taken off.  For search, digits sampled
from the two longest whole octaves make bands; texts that share a band are
candidates, and the likeness verifies them.

Spark.  Ids that occur, chosen by their hash, cut the order of ids into ranges;
each range also gets a copy of the first row of the next one.  Texts are
exchanged once, by range, and sorted; a row is compared with its successor as
the rows stream by, so a task holds two texts.

Defined cases: null text is empty; empty texts are alike (1) and unlike all
others (0); rows are ordered by id (null first), equal ids by text; a single
row is its own successor; an empty table gives no rows; ids of any type Spark
can order; columns besides doc_id and text are left out.
"""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left, bisect_right
from functools import cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm.common import prepare, shuffle_partitions, written

SEED = 20                 # of the walk's bits and the sampled places
FIRST_STEPS = 64          # all sampled
SAMPLES = 64              # of each octave after them
PERIOD = 256              # the bits repeat after so many steps
CHUNK = 1 << 16           # characters walked at a time
BANDS, BAND_DIGITS = 16, 5   # of each of two octaves
CHANCE = 1 / 16
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _moves() -> list[bytes]:
    """For each of 256 classes of characters: where in the period the walk is when it moves on, by where it came."""
    bits = np.random.default_rng(SEED).integers(0, 2, (256, PERIOD), np.uint8)
    bits[:, -1] = 1
    moves = np.zeros((256, PERIOD), np.uint8)
    at = np.zeros(256, np.int64)
    for step in range(2 * PERIOD - 1, -1, -1):            # twice round, so that the end knows the start
        at = np.where(bits[:, step % PERIOD] == 1, (step + 1) % PERIOD, at)
        if step < PERIOD:
            moves[:, step] = at
    return [bytes(m) for m in moves]


MOVES = _moves()


def sampled_steps(steps: int) -> list[int]:
    """The places below ``steps``, ascending."""
    out = list(range(min(steps, FIRST_STEPS)))
    low = FIRST_STEPS
    while low < steps:
        places = sorted(random.Random(SEED * 1000 + low.bit_length()).sample(range(low, 2 * low), SAMPLES))
        out += places[:bisect_left(places, steps)]
        low *= 2
    return out


_places = np.array(sampled_steps(1 << 20))


def _places_between(first: int, stop: int) -> np.ndarray:
    global _places
    if stop > _places[-1]:
        _places = np.array(sampled_steps(2 * stop))
    a, b = np.searchsorted(_places, (first, stop))
    return _places[a:b]


def classes(text: str) -> bytes:
    """One of 256 classes for each code point; those below 256 have their own."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return np.where(code < 256, code, (code * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8).tobytes()


class Walk:
    """The walk over a text that is fed in parts; a copy goes on by itself."""

    __slots__ = ("step", "last", "digits")

    def __init__(self, step: int = 0, last: bytes = b"\0\0", digits: bytes = b""):
        self.step, self.last, self.digits = step, last, digits

    def copy(self) -> Walk:
        return Walk(self.step, self.last, self.digits)

    def feed(self, read: bytes) -> Walk:
        for a in range(0, len(read), CHUNK):
            self._feed(read[a:a + CHUNK])
        return self

    def _feed(self, read: bytes) -> None:
        at = self.step % PERIOD
        # the only loop over characters: one table look-up each
        left = np.frombuffer(bytes([at := move[at] for move in map(MOVES.__getitem__, read)]), np.uint8)
        came = np.empty(len(left) + 1, np.int64)
        came[0], came[1:] = self.step % PERIOD, left
        waits = (came[1:] - came[:-1]) % PERIOD
        waits[waits == 0] = PERIOD
        came[0] = self.step
        np.cumsum(waits, out=came[1:])
        came[1:] += self.step
        places = _places_between(self.step, int(came[-1]))
        k = np.searchsorted(came, places, "right")            # character k - 1 of the part, k + 1 of seen
        seen = np.frombuffer(self.last + read, np.uint8).astype(np.uint32)
        mixed = seen[k + 1] * np.uint32(0x9E3779B1) + seen[k] * np.uint32(0x85EBCA77) + seen[k - 1] * np.uint32(0xC2B2AE3D)
        mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        self.digits += HEX[mixed >> np.uint32(28)].tobytes()
        self.step, self.last = int(came[-1]), (self.last + read)[-2:]

    def fingerprint(self) -> str:
        return f"{self.step:x}:{self.digits.decode()}"


def fingerprint(text: str | None) -> str:
    return Walk().feed(classes(text or "")).fingerprint()


def likeness(a: str, b: str) -> float:
    """Estimated share of equal steps, 0 to 1."""
    if a == b:
        return 1.0
    (steps_a, digits_a), (steps_b, digits_b) = a.split(":"), b.split(":")
    steps = max(int(steps_a, 16), int(steps_b, 16))
    if not min(len(digits_a), len(digits_b)):
        return 0.0
    same = np.zeros(max(len(digits_a), len(digits_b)), bool)
    both = min(len(digits_a), len(digits_b))
    same[:both] = (np.frombuffer(digits_a[:both].encode(), np.uint8) == np.frombuffer(digits_b[:both].encode(), np.uint8))
    equal, low, at, high = 0.0, 0, 0, FIRST_STEPS
    while low < steps:
        here = same[at:at + SAMPLES]
        if len(here):
            equal += here.mean() * (min(high, steps) - low)
        else:
            steps = low                                       # no place sampled in the rest
        low, high, at = high, 2 * high, at + SAMPLES
    return min(1.0, max(0.0, (equal / steps - CHANCE) / (1 - CHANCE)))


@cache
def _band_places(octave: int) -> list:
    r = random.Random(SEED + octave)
    return [(f"{octave}.{b}.", itemgetter(*r.sample(range(SAMPLES), BAND_DIGITS))) for b in range(BANDS)]


def band_keys(print_: str) -> list[str]:
    """Bands of a fingerprint: digits sampled from its last two whole octaves (the first steps of short texts)."""
    steps, digits = print_.split(":")
    whole = int(steps, 16) // FIRST_STEPS
    if not whole:
        return [print_]                                       # shorter than any octave: itself
    last = whole.bit_length() - 1                             # octave 0 are the first steps
    out = []
    for octave in range(max(0, last - 1), last + 1):
        own = digits[octave * SAMPLES:(octave + 1) * SAMPLES]
        if len(own) < SAMPLES:
            continue
        out += [name + "".join(chosen(own)) for name, chosen in _band_places(octave)]
    return out


# ----------------------------------------------------------------------------- Spark
def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row; no shuffle."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.string())],
                ["doc_id", "fingerprint"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fingerprint string")


def search(queries: DataFrame, prints: DataFrame, least: float = 0.7) -> DataFrame:
    """(query_id, fingerprint, likeness, n_docs): for each query the fingerprints at least so alike, and how many
    rows have them.  Both sides have doc_id, fingerprint.

    Equal fingerprints are folded before the bands are made, so a group of copies is one row of a
    band; the band is an ordinary join key that adaptive execution can split.
    """
    @F.arrow_udf("array<string>")
    def keys(prints: pa.Array) -> pa.Array:
        return pa.array([band_keys(x) for x in prints.to_pylist()], pa.list_(pa.string()))

    folded = written(prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_docs")), "fingerprints")
    banded = folded.select("fingerprint", "n_docs", F.explode(keys("fingerprint")).alias("band"))
    asked = queries.select("fingerprint").distinct().select(F.col("fingerprint").alias("asked"),
                                                            F.explode(keys("fingerprint")).alias("band"))
    pairs = asked.join(banded, "band").select("asked", "fingerprint", "n_docs").distinct()

    def verify(batches):
        for batch in batches:
            scores = [likeness(a, b) for a, b in zip(batch.column("asked").to_pylist(), batch.column("fingerprint").to_pylist())]
            yield batch.append_column("likeness", pa.array(scores, pa.float64()))

    verified = pairs.mapInArrow(verify, "asked string, fingerprint string, n_docs long, likeness double")
    verified = verified.filter(F.col("likeness") >= least)
    who = queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("asked"))
    return who.join(verified, "asked").select("query_id", "fingerprint", "likeness", "n_docs")


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
          "edited_banded", "next_banded"]


class _Row:
    """A text with the walk over its first part and over all of it."""

    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text or ""
        self.stay = len(self.text) - len(self.text) // 2
        self.front = Walk().feed(classes(self.text[:self.stay]))
        self.print = self.front.copy().feed(classes(self.text[self.stay:])).fingerprint()
        self.bands = frozenset(band_keys(self.print))

    def against(self, after: _Row) -> tuple:
        """The result of this row, whose successor is ``after``."""
        taken = after.text[:len(self.text) - self.stay]
        edited = self.front.copy().feed(classes(taken)).fingerprint()
        return (self.doc_id, len(self.text), hashlib.sha256((self.text[:self.stay] + taken).encode()).hexdigest(),
                self.print, edited, likeness(self.print, edited), likeness(self.print, after.print),
                not self.bands.isdisjoint(band_keys(edited)), not self.bands.isdisjoint(after.bands))


def range_starts(docs: DataFrame, ranges: int, first) -> list:
    """At most ``ranges - 1`` ids that occur, ascending, which cut the ids into ranges of about one size.

    They come from a sample by hash of the distinct ids, a few for each range; ``first``, the id that all rows
    begin with, is not one of them, so no range is empty.
    """
    ids = docs.select("doc_id").dropna().distinct()
    some = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(16 * ranges).collect()
    some = sorted(r["doc_id"] for r in some)
    return sorted({some[k * len(some) // ranges] for k in range(1, ranges) if some} - {first})


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every row with its edited text (the second half replaced by the start of the next document) and the
    likeness of its fingerprint to that text's and to the next document's."""
    spark = docs.sparkSession
    prepare(spark)
    ranges = shuffle_partitions(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    result = (f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, edited_banded boolean, next_banded boolean")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_()]
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ends = docs.agg(F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    first = None if ends["nulls"] else ends["least"]
    starts = range_starts(docs, ranges, first)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        return pa.array([0 if x is None else bisect_right(starts, x) for x in ids.to_pylist()], pa.int32())

    rows = docs.withColumn("part", range_of("doc_id")).withColumn("extra", F.lit(False))
    # the first row of each range goes to the range before, that of the first range to the last
    heads = spark.createDataFrame([(x, k) for k, x in enumerate(starts)] + [(first, len(starts))], f"head {id_type}, part int")
    extra = (docs.join(F.broadcast(heads), docs["doc_id"].eqNullSafe(heads["head"]))     # one row a range
             .groupBy("part").agg(F.min("text").alias("text"))
             .select(F.lit(None).cast(id_type).alias("doc_id"), "text", "part", F.lit(True).alias("extra")))
    ordered = rows.unionByName(extra).repartitionByRange(ranges, "part").sortWithinPartitions("part", "extra", "doc_id", "text")

    def run(batches):
        before, open_part = None, None
        for batch in batches:
            out = []
            for doc_id, text, part, extra in zip(*(batch.column(c) if c == "text" else batch.column(c).to_pylist()
                                                   for c in ("doc_id", "text", "part", "extra"))):
                row = _Row(doc_id, text.as_py())
                if before is not None and part == open_part:
                    out.append(before.against(row))
                before, open_part = None if extra else row, part
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[] for _ in RESULT],
                                                [batch.schema.field("doc_id").type, *kinds])], RESULT)

    return ordered.mapInArrow(run, result)
