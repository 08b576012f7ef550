"""Words and word hashes of whole Arrow batches of text, without a Python loop per word.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which in UTF-8 is
the pattern ``[^\\x20\\x09-\\x0D]+``.  Its hash is a polynomial over a table of
random byte values, read off a running sum: the sum between two positions,
divided by the power at the first, does not depend on where the word stands.
All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20          # bytes hashed at a time; a longer text is cut between words
SLICE = 4 << 20            # bytes of text handed on at a time
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
U = np.uint64
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def combine(hashes, seed: int = 0) -> np.ndarray:
    """One hash of a sequence of aligned hash arrays; order and length matter."""
    total = None
    for k, h in enumerate(hashes):
        part = h * U((2 * k + 1) * 0xD6E8FEB86659FD93 + 2 * seed * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF | 1)
        total = part if total is None else (total ^ (total >> U(29))) * U(0xFF51AFD7ED558CCD) + part
    return mix(total + U(seed))


def _power_tables(n: int):
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, SEGMENT + 4096)
        up = np.full(size, BASE, U)
        down = np.full(size, pow(BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)
    return _powers["up"], _powers["down"]


def _byte_tables():
    codes = np.arange(256)
    lower = codes + 32 * ((codes >= 65) & (codes <= 90))
    # a shape keeps marks as they are and folds letters, capitals and digits to one byte each
    shape = np.where((codes >= 97) & (codes <= 122) | (codes >= 128), 97, codes)
    shape = np.where((codes >= 65) & (codes <= 90), 65, shape)
    shape = np.where((codes >= 48) & (codes <= 57), 48, shape)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    value = mix(codes.astype(U) + U(0x5851F42D4C957F2D))
    return space, value[lower], value, shape, value[shape]


class Words:
    """Words of a run of texts: ``doc`` (row in the run), ``hash``; with ``spans`` also byte starts and ends."""

    def __init__(self, doc, hash_, shape=None, start=None, end=None):
        self.doc, self.hash, self.shape, self.start, self.end = doc, hash_, shape, start, end


def buffers(texts: pa.Array):
    """(bytes, offsets) of a string array; null texts are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, lower: bool = False, shapes: bool = False, spans: bool = False, stem: int = 0) -> Words:
    """Words of every text in order.  ``lower`` folds A-Z; ``shapes`` adds the hash of the
    word's shape (runs of letters, capitals and digits folded to one mark each); ``stem``
    adds, as ``shape``, the hash of the word's first ``stem`` bytes instead."""
    data, offsets = buffers(texts)
    space, low_value, value, shape_of, shape_value = _byte_tables()
    out: list[tuple] = []
    at, n = 0, len(data)
    while at < n:
        stop = min(at + SEGMENT, n)
        while stop < n:                          # move the cut to the next space
            window = space[data[stop:stop + 4096]]
            hit = int(window.argmax())
            if window[hit]:
                stop += hit
                break
            stop += len(window)
        b = data[at:stop]
        up, down = _power_tables(len(b))
        inside = ~space[b]
        first = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[first] = inside[first]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = first[first > 0] - 1
        last[cut] = inside[cut]
        s, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
        total = np.zeros(len(b) + 1, U)
        np.cumsum((low_value if lower else value)[b] * up[:len(b)], out=total[1:], dtype=U)
        got = [np.searchsorted(offsets, at + s, "right") - 1, mix((total[e] - total[s]) * down[s])]
        if stem:
            got.append(mix((total[np.minimum(e, s + stem)] - total[s]) * down[s]))
        elif shapes:
            kind = shape_of[b]
            keep = np.ones(len(b), bool)
            keep[1:] = kind[1:] != kind[:-1]
            keep |= begin
            rank = np.zeros(len(b) + 1, np.int64)
            np.cumsum(keep, out=rank[1:])
            np.cumsum(np.where(keep, shape_value[b] * up[rank[:-1]], U(0)), out=total[1:], dtype=U)
            got.append(mix((total[e] - total[s]) * down[rank[s]]))
        if spans:
            got += [at + s, at + e]
        out.append(tuple(got))
        at = stop
    width = 2 + bool(shapes or stem) + 2 * spans
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U), np.zeros(0, U)][:width]
    cols += [np.zeros(0, np.int64)] * (width - len(cols))
    w = Words(cols[0].astype(np.int64), cols[1], cols[2] if shapes or stem else None)
    if spans:
        w.start, w.end = cols[-2], cols[-1]
    return w


def _unit_classes():
    codes = np.arange(256)
    kind = np.full(256, 3, np.uint8)                                   # marks
    kind[(codes >= 65) & (codes <= 90) | (codes >= 97) & (codes <= 122)] = 1
    kind[(codes >= 48) & (codes <= 57)] = 2
    # bytes that need a tokenizer's own view of the word: control characters, all beyond
    # Latin-1, the apostrophe (contractions) and the bracket of special tokens
    kind[(codes < 32) | (codes >= 127) | (codes == 39) | (codes == 60)] = 4
    return kind


def units(texts: pa.Array) -> Words:
    """Words cut further where a pre-tokenizer cuts: runs of letters, single digits, runs of
    marks.  Letters are a-z, A-Z and the letters of Latin-1; A-Z fold in the hash.  A word with
    any other character, an apostrophe or ``<`` stays whole; ``shape`` marks these."""
    data, offsets = buffers(texts)
    space, low_value, _, _, _ = _byte_tables()
    classes = _unit_classes()
    out: list[tuple] = []
    at, n = 0, len(data)
    while at < n:
        stop = min(at + SEGMENT, n)
        while stop < n:                          # move the cut to the next space
            window = space[data[stop:stop + 4096]]
            hit = int(window.argmax())
            if window[hit]:
                stop += hit
                break
            stop += len(window)
        b = data[at:stop]
        up, down = _power_tables(len(b))
        inside = ~space[b]
        first = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[first] = inside[first]
        kind = classes[b]
        lead = np.flatnonzero(b[:-1] == 0xC3)
        letter = lead[(b[lead + 1] != 0x97) & (b[lead + 1] != 0xB7)]
        kind[letter] = kind[letter + 1] = 1
        word = np.cumsum(begin) - 1
        words_here = int(word[-1]) + 1 if len(word) else 0
        hard = np.zeros(max(1, words_here), bool)
        hard[word[inside & (kind == 4)]] = True
        start = inside & ~hard[word]
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        start |= begin
        s = np.flatnonzero(start)
        # a unit ends at the next unit or where its word ends
        last = inside.copy()
        last[:-1] &= ~inside[1:] | start[1:]
        e = np.flatnonzero(last) + 1
        total = np.zeros(len(b) + 1, U)
        np.cumsum(low_value[b] * up[:len(b)], out=total[1:], dtype=U)
        out.append((np.searchsorted(offsets, at + s, "right") - 1, mix((total[e] - total[s]) * down[s]), at + s, at + e,
                    hard[word[s]]))
        at = stop
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, U)] + [np.zeros(0, np.int64)] * 3
    return Words(cols[0].astype(np.int64), cols[1], cols[4].astype(bool), cols[2], cols[3])


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE):
    """Cut a batch into runs of whole rows of about ``limit`` bytes of text."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def sort_pairs(doc: np.ndarray, value: np.ndarray):
    """Both arrays sorted by doc, then value."""
    order = np.argsort(value)
    kind = np.uint16 if len(doc) == 0 or int(doc.max()) < 1 << 16 else np.int64
    order = order[np.argsort(doc[order].astype(kind), kind="stable")]
    return doc[order], value[order]


def shingles(w: Words, n_docs: int, size: int = 5):
    """Distinct ``size``-word shingles: (doc, hash) sorted by doc, then hash.

    A text with fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    n = len(w.doc)
    counts = np.bincount(w.doc, minlength=n_docs)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U)
    parts = []
    for k in range(size):
        h = np.zeros(n, U)
        if k < n:
            same = w.doc[k:] == w.doc[:n - k]
            h[:n - k] = np.where(same, w.hash[k:], U(0))
        parts.append(h)
    value = combine(parts)
    whole = np.zeros(n, bool)
    if n >= size:
        whole[:n - size + 1] = w.doc[size - 1:] == w.doc[:n - size + 1]
    starts = np.cumsum(counts) - counts
    short = (counts > 0) & (counts < size)
    whole[starts[short]] = True
    doc, value = w.doc[whole], value[whole]
    doc, value = sort_pairs(doc, value)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[fresh], value[fresh]
