"""Stupid-backoff language-model scores, computed by joins on n-gram hashes.

Counts are taken over all documents, and every document is scored against
them.  For a context h of up to ``order - 1`` words  S(w | h) = c(h w) / c(h)
where the n-gram was counted ``min_count`` times or more, else
``alpha`` * S(w | h without its first word); at last S(w) = c(w) / N.  A text
starts with the word ``<s>``, so its first words have shorter contexts.  A
document's score is the sum of log S over its words.

1. Heavy n-grams.  Every task names those that make up a share of its block;
   the most frequent of them (``order * HEAVY`` at most, over all lengths) are
   counted exactly over all documents.  That table has a fixed bound and is broadcast.  It
   decides routes, and spares the hottest n-grams the shuffle; the scores do
   not depend on it.
2. All other occurrences are exploded, each with the words before it, and dealt
   by the hash of the last context word v; where v is heavy, by the hash of the
   shortest n-gram ending in the word that is not heavy.  They travel in
   columns: blocks with a local dictionary of words (a heavy one is its place in
   the broadcast table), packed.  A bucket thus holds all occurrences of every
   longer n-gram too, at any order.
3. In a bucket the counts are joined to the occurrences.  Scores are summed by
   document.  A word that backs off to the end is scored in its own bucket, where
   it is the last context word: there its count is known, and the count of its
   pair with the word before, which says that it backs off.  Only counts of
   contexts that end in a heavy word are asked of the bucket that holds them.
4. The sums of all buckets go to the buckets of their documents and are added up.

Defined cases: ids are integers above -2**63; null or empty text has 0 words and
score 0; rows with equal ids are one document whose words and scores add up
(null ids are one of them); an
empty table gives no rows; other columns are ignored.  Words are compared by
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm import words as W
from brewlens.llm.common import prepare, shuffle_partitions

ALPHA = 0.4
ORDER = 2                # words in the longest n-gram; the query sets its own
MIN_COUNT = 2
HEAVY = 4096             # n-grams in the broadcast table: order times so many at most, over all lengths
SHARE = 2000             # a task names an n-gram that is one in so many of its block
BLOCK_WORDS = 1 << 20
CHUNK = 1 << 15          # n-grams in a row at most; fewer at a higher order, so that places in the row's lists fit 16 bits
START = W.U(1)           # hash of the context before the first word
END = W.U(2)             # hash of "no word follows"
ABSENT = W.U(3)          # hash of "before the start"
NO_ID = -(1 << 63)
ROWS = "bucket int, kind int, parts array<binary>"
SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("parts", pa.list_(pa.binary()))])
GRAMS, TABLE, UNDER, SUMS = range(4)


def windows(w: W.Words, order: int):
    """Columns of the ``order`` words that end in each word, START and ABSENT before a text; and which words are last."""
    n = len(w.hash)
    opens = np.ones(n, bool)
    opens[1:] = w.doc[1:] != w.doc[:-1]
    place = np.arange(n)
    place -= np.maximum.accumulate(np.where(opens, place, 0))
    columns = [w.hash]
    for back in range(1, order):
        column = np.full(n, ABSENT)
        column[back:] = w.hash[:n - back] if back < n else column[back:]
        columns.insert(0, np.where(place >= back, column, np.where(place == back - 1, START, ABSENT)))
    return columns, np.roll(opens, -1)


def gram_hash(columns: list[np.ndarray], k: int) -> np.ndarray:
    """Hash of the last k columns; a word is its own."""
    return columns[-1] if k == 1 else W.combine(columns[-k:], 5)


def routes(columns: list[np.ndarray], heavy: "Heavy"):
    """(key by which an occurrence is dealt, count of its last context word if that is heavy)."""
    in_v = heavy.count(columns[-2])
    key, open_ = np.where(in_v > 0, ABSENT, columns[-2]), in_v > 0
    for k in range(2, len(columns) + 1):
        open_ = open_ & (columns[-k] != ABSENT)
        hashes = gram_hash(columns, k)
        key = np.where(open_, hashes, key)
        open_ = open_ & (heavy.count(hashes) > 0)
    return key, in_v


def pack(x: np.ndarray, rising: bool = False) -> bytes:
    """An array as bytes: the first bytes of all values, then the second ones, each run compressed by itself;
    ``rising`` values as steps."""
    if rising:
        x = np.diff(x, prepend=x.dtype.type(0))
    runs = [pa.compress(run.tobytes(), "zstd", asbytes=True) for run in x.view(np.uint8).reshape(len(x), x.itemsize).T]
    return np.array([len(x), *map(len, runs)], np.uint32).tobytes() + b"".join(runs)


def unpack(data: bytes, dtype, rising: bool = False) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    n, *sizes = np.frombuffer(data, np.uint32, 1 + width).tolist()
    if not n:
        return np.zeros(0, dtype)
    runs, at = np.empty((n, width), np.uint8), 4 + 4 * width
    for k, size in enumerate(sizes):
        runs[:, k] = np.frombuffer(pa.decompress(data[at:at + size], n, "zstd", asbytes=True), np.uint8)
        at += size
    x = runs.reshape(-1).view(dtype)
    return np.cumsum(x, dtype=dtype) if rising else x


def _sums(bucket: int, ids: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple:
    """Words and scores of documents; ids ascending."""
    return bucket, SUMS, [pack(ids, True), pack(n), pack(total)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(SCHEMA)], schema=SCHEMA)


def _cuts(sorted_: np.ndarray):
    """(first, end) of every run of equal values."""
    cuts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)
    return zip(cuts.tolist(), np.append(cuts[1:], len(sorted_)).tolist())


def _totals(keys: np.ndarray, values: np.ndarray):
    """Distinct keys and the sums of their values."""
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which, weights=values, minlength=len(distinct))


class Heavy:
    """The broadcast table: exact counts of heavy words and pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(keys)
        self.keys, self.counts, self.total = keys[order], counts[order], total

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Counts; 0 where the n-gram is not in the table."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.counts[at], 0)

    def pack(self, words: np.ndarray):
        """(bytes of the words, their places among the words as unpacked); the words ascend."""
        at = np.searchsorted(self.keys, words)
        known = self.count(words) > 0
        place = np.where(known, np.cumsum(known) - 1, np.count_nonzero(known) + np.cumsum(~known) - 1)
        return [pack(at[known].astype(np.uint32), True), pack(words[~known], True)], place

    def unpack(self, known: bytes, others: bytes) -> np.ndarray:
        return np.concatenate([self.keys[unpack(known, np.uint32, True)], unpack(others, W.U, True)])


def heavy_ngrams(docs: DataFrame, order: int) -> Heavy:
    texts = docs.select("text")

    def grams(w: W.Words):
        columns, _ = windows(w, order)
        return [w.hash] + [gram_hash(columns, k)[columns[-k] != ABSENT] for k in range(2, order + 1)], columns

    def name(batches):
        held, size = [], 0

        def told(parts):
            every = np.concatenate(parts)
            keys, counts = np.unique(every, return_counts=True)
            keep = counts * SHARE >= len(every) // order
            return pa.RecordBatch.from_pydict({"ngram": keys[keep].view(np.int64), "seen": counts[keep]})

        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"))
                held += grams(w)[0]
                size += len(w.hash)
                if size >= BLOCK_WORDS // 2:
                    yield told(held)
                    held, size = [], 0
        if size:
            yield told(held)

    named = texts.mapInArrow(name, "ngram long, seen long").groupBy("ngram").agg(F.sum("seen").alias("seen"))
    some = [r["ngram"] for r in named.orderBy(F.desc("seen"), "ngram").limit(order * HEAVY).collect()]
    wanted = np.sort(np.append(np.array(some, np.int64).view(W.U), START))

    def count(batches):
        total, seen = 0, np.zeros(len(wanted), np.int64)
        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"))
                every, columns = grams(w)
                total += len(w.hash)
                for keys in (*every, columns[-2][columns[-2] == START]):
                    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
                    seen += np.bincount(at[wanted[at] == keys], minlength=len(wanted))
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(wanted) + 1), "seen": np.append(seen, total)})

    got = texts.mapInArrow(count, "place long, seen long").groupBy("place").agg(F.sum("seen").alias("seen")).collect()
    seen = np.zeros(len(wanted) + 1, np.int64)
    for r in got:
        seen[r["place"]] = r["seen"]
    return Heavy(wanted, seen[:-1], int(seen[-1]))


def score(docs: DataFrame, alpha: float = ALPHA, min_count: int = MIN_COUNT, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, log_score, mean_log_score of every document."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    prepare(spark)
    buckets = shuffle_partitions(spark)
    table = heavy_ngrams(docs, order)
    carry = max(order, 3)   # the word before the last context word tells whether that one backs off
    chunk = min(CHUNK, (1 << 16) // carry)
    # plain arrays: workers need no copy of this package to unpickle them
    shared = spark.sparkContext.broadcast((table.keys, table.counts, table.total))
    log_alpha = float(np.log(alpha))

    def bucket_of(hashes):
        return ((hashes >> W.U(32)) % W.U(buckets)).astype(np.int64)

    def explode(batches):
        heavy = Heavy(*shared.value)
        held, size, turn = [], 0, 0

        def deal(parts):
            ids, n, scores, key, doc, *columns = (np.concatenate(x) for x in zip(*parts))
            light = key == columns[-2]      # heavy words come first, as in the dictionary
            bucket = 2 * bucket_of(key) + light
            by = np.lexsort((columns[-2], bucket))
            doc, bucket, columns = doc[by], bucket[by] >> 1, [c[by] for c in columns]
            rows = []
            for a, b in _cuts(bucket):
                for c in range(a, b, chunk):
                    e = min(b, c + chunk)
                    known, place = np.unique(np.concatenate([x[c:e] for x in columns]), return_inverse=True)
                    own, at = np.unique(doc[c:e], return_inverse=True)
                    words, moved = heavy.pack(known)
                    places = moved[place].astype(np.uint16).reshape(carry, e - c)
                    rows.append((int(bucket[c]), GRAMS, [
                        pack(own, True), pack(at.astype(np.uint16)), *words,
                        *(pack(p, m == carry - 2) for m, p in enumerate(places))]))    # sorted by the last context word
            # words and scores already known, by document; any bucket will do
            ids, which = np.unique(ids, return_inverse=True)
            n, scores = (np.bincount(which, weights=x, minlength=len(ids)) for x in (n, scores))
            rows.append(_sums(turn % buckets, ids, n.astype(np.int64), scores))
            return _batch(rows)

        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"))
                ids = part.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                columns, closes = windows(w, carry)
                # a last word occurs as a context that nothing follows
                columns = [np.concatenate([c, after[closes]]) for c, after in
                           zip(columns, [*columns[1:], np.full(len(w.hash), END)])]
                doc = np.concatenate([w.doc, w.doc[closes]])
                key, in_v = routes(columns[-order:], heavy)
                # known here: all n-grams that end in the word, and the longest context, are heavy
                done, seen, under = in_v > 0, np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
                for k in range(2, order + 1):
                    there = columns[-k] != ABSENT
                    count = heavy.count(gram_hash(columns, k))
                    done &= ~there | (count > 0)
                    seen = np.where(there, count, seen)
                    under = np.where(there, heavy.count(gram_hash(columns[:-1], k - 1)), under)
                done &= (seen >= min_count) & (under > 0)
                known = np.bincount(doc[done], weights=np.log(seen[done] / under[done]), minlength=part.num_rows)
                send = ~done & ~((in_v > 0) & (columns[-1] == END))
                held.append((ids, np.bincount(w.doc, minlength=part.num_rows), known, key[send], ids[doc[send]],
                             *[c[send] for c in columns]))
                size += len(doc)
                if size >= BLOCK_WORDS:
                    yield deal(held)
                    held, size, turn = [], 0, turn + 1
        if held:
            yield deal(held)

    def parts(table: pa.Table, kind: int) -> list[list[bytes]]:
        return table.filter(pa.compute.equal(table.column("kind"), kind)).column("parts").to_pylist()

    def flat(arrays, dtype=np.int64):
        return np.concatenate(arrays) if arrays else np.zeros(0, dtype)

    def sums_of(table: pa.Table):
        """Lists of the ids, words and scores of SUMS rows."""
        got = [(unpack(i, np.int64, True), unpack(n, np.int64), unpack(x, np.float64)) for i, n, x in parts(table, SUMS)]
        return [list(x) for x in zip(*got)] or [[], [], []]

    def summed(sums):
        """Lists of ids, words and scores folded to one entry for each document."""
        ids, n, x = (flat(s) for s in sums)
        keys, total = _totals(ids, x.astype(np.float64))
        return keys, _totals(ids, n)[1].astype(np.int64), total

    def by_document(sums):
        """SUMS rows for the buckets of the documents."""
        ids, n, total = summed(sums)
        to = bucket_of(W.mix(ids.view(W.U)))
        by = np.argsort(to, kind="stable")
        ids, n, total, to = ids[by], n[by], total[by], to[by]
        return [_sums(int(to[a]), ids[a:b], n[a:b], total[a:b]) for a, b in _cuts(to)]

    def look_up(table: pa.Table) -> pa.Table:
        heavy = Heavy(*shared.value)
        sums = sums_of(table)
        grams = parts(table, GRAMS)
        del table
        edges = np.cumsum([0] + [int(np.frombuffer(g[1], np.uint32, 1)[0]) for g in grams])
        size = int(edges[-1])
        columns, who = [np.empty(size, W.U) for _ in range(carry)], np.empty(size, np.int64)
        for a, b, (own, at, known, others, *places) in zip(edges, edges[1:], grams):
            words = heavy.unpack(known, others)
            who[a:b] = unpack(own, np.int64, True)[unpack(at, np.uint16)]
            for m, place in enumerate(places):
                columns[m][a:b] = words[unpack(place, np.uint16, m == carry - 2)]
        del grams
        value, asked, ask = np.zeros(size), np.zeros(size, bool), np.zeros(size, W.U)
        keys, counts = [], []

        def totals(hashes):
            distinct, which, n = np.unique(hashes, return_inverse=True, return_counts=True)
            return distinct, n, n[which] if len(which) else np.zeros(0, np.int64)

        # sixteenths that hold whole count groups, so that little is held besides the n-grams
        sixteenth = routes(columns[-order:], heavy)[0] >> W.U(60)
        by = np.argsort(sixteenth.astype(np.uint8), kind="stable")
        edges = np.searchsorted(sixteenth[by], np.arange(17, dtype=W.U))
        del sixteenth
        for a, b in zip(edges, edges[1:]):
            some = by[a:b]
            cols = [c[some] for c in columns]
            # c(h) of the contexts: of a word that is not heavy all occurrences as a context are here
            in_v = heavy.count(cols[-2])
            under = [np.where(in_v > 0, in_v, totals(cols[-2])[2])]
            for k in range(2, carry):
                hashes = gram_hash(cols[:-1], k)
                broad = heavy.count(hashes)
                under.append(np.where(broad > 0, broad, np.where(in_v > 0, 0, totals(hashes)[2])))    # 0: to be asked for
            # the last context word, where it is not heavy and itself backs off to the end
            ends = (in_v == 0) & (under[1] < min_count)
            back = sum((cols[-k][ends] != ABSENT).astype(np.int64) for k in range(3, min(order + 1, carry) + 1))
            if order == carry:      # one word more was before it, unless the text starts here
                back = back + ((cols[0][ends] != ABSENT) & (cols[0][ends] != START))
            value[some[ends]] = np.log(under[0][ends] / max(1, heavy.total)) + log_alpha * back
            follows = cols[-1] != END
            some, cols, under = some[follows], [c[follows] for c in cols], [u[follows] for u in under]
            in_w = heavy.count(cols[-1])
            steps = np.zeros(len(some), np.int64)       # longest n-gram of the word, less one
            x = np.where(in_w > 0, np.log(np.maximum(in_w, 1) / max(1, heavy.total)), 0.0)
            of, level, wanted = np.zeros(len(some), W.U), np.zeros(len(some), np.int64), np.zeros(len(some), bool)
            for k in range(2, order + 1):
                there = np.flatnonzero(cols[-k] != ABSENT)
                steps[there] = k - 1
                hashes = gram_hash([c[there] for c in cols], k)
                broad = heavy.count(hashes)
                key, n, here = totals(hashes)
                c_k = np.where(broad > 0, broad, here)
                if k < order:       # counts that other buckets ask for: contexts whose last word is heavy
                    first = np.unique(hashes, return_index=True)[1]
                    give = (in_w[there][first] > 0) & (broad[first] == 0) & (n >= min_count)
                    keys.append(key[give])
                    counts.append(n[give])
                use = c_k >= min_count
                hit, c_h = there[use], under[k - 2][there[use]]
                x[hit] = np.log(c_k[use]) - np.log(np.maximum(c_h, 1))
                wanted[hit] = c_h == 0
                of[hit] = gram_hash([c[hit] for c in cols[:-1]], k - 1)
                level[hit] = k - 1
            # a word that backs off to the end and is not heavy is scored in its own bucket
            value[some] += np.where((in_w > 0) | (level > 0), x + log_alpha * (steps - level), 0.0)
            asked[some], ask[some] = wanted, of
        rows = []
        key, n = flat(keys, W.U), flat(counts)
        to = bucket_of(key)
        by = np.lexsort((key, to))
        key, n, to = key[by], n[by], to[by]
        for a, b in _cuts(to):
            rows.append((int(to[a]), TABLE, [pack(key[a:b], True), pack(n[a:b])]))
        told = np.flatnonzero(value)
        ids, total = _totals(who[told], value[told])
        for s, x in zip(sums, (ids, np.zeros(len(ids), np.int64), total)):
            s.append(x)
        rows += by_document(sums)
        w, doc = ask[asked], who[asked]
        to = bucket_of(w)
        by = np.lexsort((w, to))
        w, doc, to = w[by], doc[by], to[by]
        for a, b in _cuts(to):
            rows.append((int(to[a]), UNDER, [pack(w[a:b], True), pack(doc[a:b])]))
        return pa.Table.from_batches([_batch(rows)])

    def answer(table: pa.Table) -> pa.Table:
        told = [(unpack(w, W.U, True), unpack(n, np.int64)) for w, n in parts(table, TABLE)]
        keys, counts = _totals(flat([w for w, _ in told], W.U), flat([n for _, n in told]))
        sums = sums_of(table)
        for w, doc in parts(table, UNDER):
            asked = unpack(w, W.U, True)
            for s, x in zip(sums, (unpack(doc, np.int64), np.zeros(len(asked), np.int64),
                                   -np.log(counts[np.searchsorted(keys, asked)]))):
                s.append(x)
        return pa.Table.from_batches([_batch(by_document(sums))])

    def add_up(table: pa.Table) -> pa.Table:
        ids, n, total = summed(sums_of(table))
        return pa.table({"doc_id": ids, "n_words": n, "log_score": total})

    rows = docs.select("doc_id", "text").mapInArrow(explode, ROWS)
    looked = rows.groupBy("bucket").applyInArrow(look_up, ROWS)
    answered = looked.groupBy("bucket").applyInArrow(answer, ROWS)
    whole = answered.groupBy("bucket").applyInArrow(add_up, "doc_id long, n_words long, log_score double")
    kind = dict(docs.dtypes)["doc_id"]
    return whole.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).cast(kind).alias("doc_id"), "n_words", "log_score",
                        (F.col("log_score") / F.greatest(F.col("n_words"), F.lit(1))).alias("mean_log_score"))
