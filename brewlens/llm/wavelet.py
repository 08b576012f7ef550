"""Token ids of whole texts in wavelet-matrix files, one file per shard.

Documents are range-partitioned and sorted by doc_id; every task encodes its
run of texts and writes shards of bounded size.  A shard file holds the ids of
its documents (each ended by the id 1) as a wavelet matrix: one bit-plane per
bit of an id, highest first, each plane's ones moved behind its zeros before
the next plane is cut.  With running counts of ones per block a file answers
access, rank (count of a token before a place), select (place of the k-th
occurrence) and occurrence lookup from the planes alone.

File: magic ``WVM2``; the length of a JSON header; the header (counts and the
places of what follows); the document table (ids and lengths, an Arrow stream,
zlib-compressed); then per plane the running counts of ones at every block,
the rank directory, and the plane's bits.  Both are stored as they are, so
``TokenFile`` answers from a few bytes of each plane and never reads the rest.

Files go to the shared checkpoint folder by its URI.  A task writes under a
name of its own attempt, and the manifest, which Spark commits, names the
files that count, so lost executors and repeated attempts leave no doubt.
Where each file starts among all ids is a running sum over the manifest.

Words repeat, so a task encodes each distinct piece of text once.  Pieces are
words, cut further into runs of letters, single digits and runs of marks: the
tokenizer cuts there too and never joins across, so the ids of a text are
those of its pieces in a row.  Words that need more care (apostrophes, special
tokens, characters beyond Latin-1) are encoded whole.  A tokenizer that does not
cut like this, or keeps capitals apart, is given whole texts instead.  An
encoder and what it remembers live as long as their Python worker.

Defined cases: null text is empty (only the end id); null ids come first;
equal ids stay in one run, in the order of their texts; an empty table gives
no shard and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brewlens.llm import words as W
from brewlens.llm.common import prepare, qualified, shuffle_partitions, written
from brewlens.session import scratch_path

MAGIC = b"WVM2"
END_ID = 1
SHARD_TOKENS = 1 << 21
BLOCK = 512                # bits per running count
TABLE_SLOTS = 1 << 22      # an encoder remembers half as many pieces (about 100 MB)
JOINED = 64                # pieces encoded in one text
ENCODE_BYTES = 1 << 18     # of text at a time: what is gone through again and again stays in the processor's cache


# ------------------------------------------------------------------ the matrix
def build(ids: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[int]]:
    """Packed bit-planes, and the zeros of each."""
    planes, zeros = [], []
    ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        bit = (ids & ids.dtype.type(1 << level)) != 0
        planes.append(np.packbits(bit))
        ones = int(np.count_nonzero(bit))
        zeros.append(len(bit) - ones)
        if level:
            moved = np.empty_like(ids)
            np.compress(~bit, ids, out=moved[:len(bit) - ones])
            np.compress(bit, ids, out=moved[len(bit) - ones:])
            ids = moved
    return planes, zeros


def unfold(planes: list[np.ndarray], zeros: list[int], n: int) -> np.ndarray:
    """All ids: the planes undone from the last to the first."""
    ids = np.zeros(n, np.uint16 if len(planes) <= 16 else np.uint32)
    for level, (plane, z) in enumerate(zip(reversed(planes), reversed(zeros))):
        bit = np.unpackbits(plane, count=n).view(bool)
        back = np.empty_like(ids)
        back[~bit] = ids[:z]
        back[bit] = ids[z:] | ids.dtype.type(1 << level)
        ids = back
    return ids.astype(np.uint32)


def running_ones(plane: np.ndarray) -> np.ndarray:
    """Ones before every block of a packed plane, and all of them."""
    ones = np.bitwise_count(plane).astype(np.int64)
    per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
    return np.concatenate([[0], np.cumsum(per)])


class WaveletMatrix:
    """Rank and select over packed planes of ``n`` ids."""

    def __init__(self, planes: list, zeros: list[int], n: int, counts: list | None = None):
        self.planes, self.zeros, self.n, self.bits = planes, zeros, n, len(planes)
        self.counts = [running_ones(p) for p in planes] if counts is None else counts

    def _ones(self, level: int, place: int) -> int:
        block = place // BLOCK
        p = self.planes[level]
        part = p[block * BLOCK // 8:(place + 7) // 8]
        total = int(self.counts[level][block]) + int(np.bitwise_count(part).sum())
        extra = -place % 8          # bits of the last byte at and behind the place
        if extra and len(part):
            total -= int(np.bitwise_count(part[-1] & np.uint8((1 << extra) - 1)))
        return total

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level][place // 8]) >> (7 - place % 8) & 1
            ones = self._ones(level, place)
            place = self.zeros[level] + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        low, high = 0, stop
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (self.bits - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, stop: int) -> int:
        """Occurrences of a token before a place."""
        low, high = self._range(token, max(0, min(stop, self.n)))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence, from 0; -1 if there are fewer."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            return -1
        place = low + k
        for level in range(self.bits - 1, -1, -1):
            if token >> (self.bits - 1 - level) & 1:
                place = self._find(level, place - self.zeros[level], ones=True)
            else:
                place = self._find(level, place, ones=False)
        return place

    def _find(self, level: int, k: int, ones: bool) -> int:
        """Place of the k-th one or zero of a plane, by halving."""
        low, high = 0, self.n
        while high - low > 1:
            mid = (low + high) // 2
            before = self._ones(level, mid)
            if (before if ones else mid - before) <= k:
                low = mid
            else:
                high = mid
        return low

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


# ------------------------------------------------------------------ the file
def dump(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    bits = max(1, int(ids.max(initial=0)).bit_length())
    planes, zeros = build(ids, bits)
    table, held = pa.table({"doc_id": doc_ids, "length": pa.array(lengths, pa.int64())}), pa.BufferOutputStream()
    with pa.ipc.new_stream(held, table.schema) as out:
        out.write_table(table)
    parts = [zlib.compress(held.getvalue().to_pybytes(), 1)]
    for p in planes:
        parts += [running_ones(p).astype("<u4").tobytes(), p.tobytes()]
    head = json.dumps({"n": len(ids), "docs": len(doc_ids), "zeros": zeros, "sizes": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *parts])


class _Stored:
    """Numbers at a place of a file, read as they are asked for."""

    def __init__(self, file, at: int, size: int, kind: str):
        self.file, self.at, self.kind = file, at, np.dtype(kind)
        self.length = size // self.kind.itemsize

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, which):
        first, stop, _ = which.indices(self.length) if isinstance(which, slice) else (which, which + 1, 1)
        size = self.kind.itemsize
        got = np.frombuffer(self.file.read_at(max(0, stop - first) * size, self.at + first * size), self.kind)
        return got if isinstance(which, slice) else got[0]


class TokenFile:
    """A token file, opened for reading at any place (a pyarrow file or buffer reader)."""

    def __init__(self, file):
        self.file = file
        if file.read_at(4, 0) != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(file.read_at(4, 4), "little")
        self.head = json.loads(file.read_at(size, 8))
        self.edges = (8 + size + np.append(0, np.cumsum(self.head["sizes"]))).tolist()
        self.n, self.n_docs = self.head["n"], self.head["docs"]

    def _part(self, k: int) -> tuple[int, int]:
        return self.edges[k], self.edges[k + 1] - self.edges[k]

    def documents(self) -> pa.Table:
        """doc_id and length of every document, in order."""
        at, size = self._part(0)
        with pa.ipc.open_stream(zlib.decompress(self.file.read_at(size, at))) as table:
            return table.read_all()

    def matrix(self) -> WaveletMatrix:
        """Access, rank, select and occurrences; each reads some bytes of every plane."""
        parts = range(1, len(self.edges) - 1, 2)
        return WaveletMatrix([_Stored(self.file, *self._part(k + 1), "u1") for k in parts], self.head["zeros"], self.n,
                             [_Stored(self.file, *self._part(k), "<u4") for k in parts])

    def ids(self) -> np.ndarray:
        """All ids."""
        planes = [np.frombuffer(self.file.read_at(size, at), np.uint8)
                  for at, size in map(self._part, range(2, len(self.edges) - 1, 2))]
        return unfold(planes, self.head["zeros"], self.n)


# ------------------------------------------------------------------ encoding
def cuts_like_units(spec: dict) -> bool:
    """True where a tokenizer's ids of a text are those of its pieces (``words.units``) in a row, whatever their case."""
    def flat(step, inner):
        return [x for s in step[inner] for x in flat(s, inner)] if step and step["type"] == "Sequence" else [step] if step else []

    normal = flat(spec["normalizer"], "normalizers")
    cuts = flat(spec["pre_tokenizer"], "pretokenizers")
    first = cuts[0] if cuts else {}
    return ("Lowercase" in [s["type"] for s in normal]
            and all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} for s in normal)
            and first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
            and first["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in cuts[1:]))


_encoders: dict = {}


def encoder(tokenizer_file: str) -> Encoder:
    """The encoder of this Python worker; it outlives the task."""
    if tokenizer_file not in _encoders:
        _encoders.clear()                     # one at a time, so memory stays bounded
        _encoders[tokenizer_file] = Encoder(tokenizer_file)
    return _encoders[tokenizer_file]


class Pieces:
    """The ids of pieces by their hash: an open-addressing table on arrays, looked up for many hashes at once."""

    def __init__(self, slots: int = TABLE_SLOTS):
        self.slots = slots
        self.keys = np.zeros(self.slots, np.uint64)
        self.entry = np.full(self.slots, -1, np.int32)
        self.start, self.size = np.zeros(self.slots // 2, np.int64), np.zeros(self.slots // 2, np.int64)
        self.ids, self.n, self.n_ids = np.zeros(1 << 16, np.uint32), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int32)
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(self.slots - 1)).astype(np.int64)
        while len(left):
            found = self.entry[slot]
            hit = (self.keys[slot] == hashes[left]) & (found >= 0)
            out[left[hit]] = found[hit]
            on = (found >= 0) & ~hit
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remember new, distinct hashes (the table stays half empty) with their ids, all in a row; their entries."""
        total = self.n_ids + len(ids)
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(total, 2 * len(self.ids)) - len(self.ids), np.uint32)])
        self.ids[self.n_ids:total] = ids
        entries = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.start[entries], self.size[entries] = self.n_ids + np.cumsum(sizes) - sizes, sizes
        self.n, self.n_ids = self.n + len(hashes), total
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(self.slots - 1)).astype(np.int64)
        while len(left):
            free = self.entry[slot] < 0
            self.entry[slot[free]] = entries[left[free]]         # of several the last one stays
            own = self.entry[slot] == entries[left]
            self.keys[slot[own]] = hashes[left[own]]
            left, slot = left[~own], (slot[~own] + 1) & (self.slots - 1)
        return entries


class Encoder:
    """Ids of whole texts: each distinct word is encoded once."""

    def __init__(self, tokenizer_file: str, slots: int = TABLE_SLOTS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.by_piece = cuts_like_units(json.loads(self.tokenizer.to_str()))
        self.slots, self.known = slots, Pieces(slots)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        # ids that end a pre-token, where the vocabulary tells
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that are one pre-token each, some in a text: the end-of-word ids part them again."""
        runs = [pieces[a:a + JOINED] for a in range(0, len(pieces), JOINED)]
        ids, sizes = self._encoded([" ".join(r) for r in runs])
        stops, edges = np.flatnonzero(self.ends[ids]) + 1, np.cumsum(sizes)
        per_run = np.diff(np.searchsorted(stops, edges, "right"), prepend=0)
        if len(stops) and np.array_equal(per_run, [len(r) for r in runs]) and np.isin(edges, stops).all():
            return ids, np.diff(stops, prepend=0)
        return self._encoded(pieces)

    def _entries(self, w, raw: bytes) -> np.ndarray:
        """The table's entry of every unit; those it lacks are encoded.  ``shape`` marks words that are not one pre-token."""
        entry = self.known.find(w.hash)
        lacking = np.flatnonzero(entry < 0)
        if not len(lacking):
            return entry
        hashes, at, which = np.unique(w.hash[lacking], return_index=True, return_inverse=True)
        if self.known.n + len(hashes) > self.known.slots // 2:
            # full: begin anew with this slice, with more room if one very long text needs it
            distinct = len(np.unique(w.hash))
            self.known = Pieces(max(self.slots, 2 << distinct.bit_length()))
            return self._entries(w, raw)
        first = lacking[at]
        new = np.empty(len(hashes), np.int32)
        for mine, encode in ((np.flatnonzero(w.shape[first]), self._encoded), (np.flatnonzero(~w.shape[first]), self._joined)):
            for some in (mine[a:a + 10_000] for a in range(0, len(mine), 10_000)):
                starts, ends = w.start[first[some]].tolist(), w.end[first[some]].tolist()
                new[some] = self.known.add(hashes[some], *encode([raw[a:b].decode() for a, b in zip(starts, ends)]))
        entry[lacking] = new[which]
        return entry

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with the end id; their lengths)."""
        n = len(texts)
        if not self.by_piece:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            lists = [[*e.ids, END_ID] for e in found]
            return (np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64))
        data, _ = W.buffers(texts)
        w = W.units(texts)
        entry = self._entries(w, data.tobytes())
        sizes = self.known.size[entry]
        lengths = np.bincount(w.doc, weights=sizes, minlength=n).astype(np.int64) + 1
        ends = np.cumsum(lengths)
        ids = np.empty(int(ends[-1]) if n else 0, np.uint32)
        own = np.ones(len(ids), bool)
        own[ends - 1] = False
        ids[ends - 1] = END_ID
        if len(entry):
            shift = np.repeat(self.known.start[entry] - (np.cumsum(sizes) - sizes), sizes)
            ids[own] = self.known.ids[shift + np.arange(len(shift))]
        return ids, lengths


def write_shards(docs: DataFrame, tokenizer_file: str, folder: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the files; the manifest: shard (order), file, docs, n_tokens, one row per file."""
    prepare(docs.sparkSession)
    parts, target = shuffle_partitions(docs.sparkSession), qualified(docs.sparkSession, folder)
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches):
        import os
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        context = TaskContext.get()
        store, root = pafs.FileSystem.from_uri(target)
        store.create_dir(root, recursive=True)
        serial, doc_ids, lengths, held, size = 0, [], [], [], 0

        def flush():
            nonlocal serial, doc_ids, lengths, held, size
            name = f"shard-{context.partitionId():08d}-{serial:08d}-{uuid.uuid4().hex[:12]}.wvm"
            named, n = pa.concat_arrays(doc_ids), np.concatenate(lengths)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(dump(named, n, np.concatenate(held)))
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([context.partitionId()], pa.int32()), "serial": pa.array([serial], pa.int32()),
                "file": [name], "docs": pa.array([len(named)], pa.int64()), "n_tokens": pa.array([size], pa.int64())})
            serial, doc_ids, lengths, held, size = serial + 1, [], [], [], 0
            return row

        for batch in batches:
            for part in W.slices(batch, limit=ENCODE_BYTES):
                ids, n = encoder(tokenizer_file).encode(part.column("text"))
                held.append(ids)
                lengths.append(n)
                doc_ids.append(part.column("doc_id"))
                size += len(ids)
                if size >= shard_tokens:
                    yield flush()
        if doc_ids:
            yield flush()

    return written(ordered.mapInArrow(run, "part int, serial int, file string, docs long, n_tokens long"), "token-manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids in all files before.  The ranges' sums are a row each, and only
    these meet in one window; files are summed within their range."""
    ranges = manifest.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("part").alias("range"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("serial").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.join(ranges, manifest["part"] == ranges["range"])
            .withColumn("base", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .drop("range", "before"))


def on_files(manifest: DataFrame, folder: str, work, schema: str) -> DataFrame:
    """``work(TokenFile, row)`` on every file of the manifest; it yields the batches of ``schema``.

    The files are dealt out; a task opens one after another.
    """
    spark = manifest.sparkSession
    target = qualified(spark, folder)

    def run(batches):
        store, root = pafs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as file:
                    yield from work(TokenFile(file), row)

    return manifest.repartition(shuffle_partitions(spark), "file").mapInArrow(run, schema)


def read_documents(folder: str, manifest: DataFrame, id_type: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    def work(file, row):
        table, ids = file.documents(), file.ids().astype("<u4")
        lengths = table.column("length").to_numpy()
        ends = np.cumsum(lengths)
        crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(row["base"] + ends - lengths), pa.array(lengths),
             pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return on_files(placed(manifest), folder, work, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def occurrences(folder: str, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, place): every place of the tokens among all ids, by rank and select on each file, which reads
    only some bytes of it.  A token asked for twice is told once."""
    tokens = list(dict.fromkeys(tokens))

    def work(file, row):
        matrix = file.matrix()
        for token in tokens:
            places = matrix.occurrences(token)
            for a in range(0, len(places), 100_000):
                some = np.array(places[a:a + 100_000], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), token)), pa.array(row["base"] + some)],
                                                 ["token", "place"])

    return on_files(placed(manifest), folder, work, "token long, place long")


def counts(folder: str, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each token occurs in all files, by rank on each file."""
    tokens = list(dict.fromkeys(tokens))

    def work(file, row):
        matrix = file.matrix()
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())],
                                         ["token", "n"])

    return on_files(manifest, folder, work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def encode_documents(docs: DataFrame, tokenizer_file: str, folder: str | None = None,
                     shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    manifest = write_shards(docs, tokenizer_file, folder, shard_tokens)
    return read_documents(folder, manifest, docs.schema["doc_id"].dataType.simpleString())
