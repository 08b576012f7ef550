"""Exact Jaccard similarity join on 5-word shingle sets in metric regions.

The Jaccard distance ``1 - |x n y| / |x u y|`` and the size of the symmetric
difference are metrics, and every step uses their triangle inequality.

1. Equal sets are folded to one member (``set_id``).
2. Rings.  The first pivot is the empty set: ``|x|`` is a set's distance to it,
   so linked sets differ little in size.  A ring holds the sets of one size
   band; sets of the next band are replicated into it as its window.
3. Regions.  In a ring, linked sets differ in at most D shingles.  The shingle
   space is cut into K > D parts; D differences cannot touch all parts, so
   linked sets agree exactly on a part that is not empty.  Sets that agree on
   a part are tied together, and the tied groups are the regions: no linked
   pair lies in two of them.  Common shingles are left out of the parts, which
   takes no difference away.  (Where too many parts of a set are empty for
   the argument, it is also tied by its least frequent shingles, as many as
   linked sets must share one of.)
4. A region is joined exactly and recursively.  Pivot sets split it into
   Voronoi cells; a set is replicated into every cell whose pivot is at most
   twice the threshold distance further than its own, which is as far as a
   linked partner can be.  In the cell of its own pivot a set is compared with
   all sets of fitting size, so each of its links is found and counted once.
5. A region that is too large for one task is cut into blocks; every ordered
   pair of blocks is a task, so that no task holds more than a region may.

Random document pivots alone cannot make the first regions here: unrelated
texts are all at distance 1 from each other, and then every window holds
everything (see README).

Defined cases: null or wordless text has an empty set, links with nothing and
is its own component; fewer words than a shingle make one shingle; equal rows
and equal sets are linked; a row without id has no component and links
nothing; ``n_links`` counts the other rows that a row is linked to directly,
equal ones too; an empty table gives no rows; other columns are ignored by ``join``
and ride along in ``deduplicate``.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm import words as W
from brewlens.llm.common import prepare, shuffle_partitions, written
from brewlens.llm.components import components

BLOCK = 1 << 20            # postings gathered before they are dealt out
COMMON_BLOCK = 1 << 21     # shingles in which a task looks for common ones
COMMON_LEAST = 3           # sets of a block that make a shingle common
COMMON_MOST = 1 << 17      # shingles in the broadcast table (2 MB)
BROADCAST_ROWS = 1 << 20   # a table of ids with fewer rows (24 MB) is broadcast


@dataclass(frozen=True)
class Settings:
    size: int = 5              # words in a shingle
    percent: int = 80          # linked: 100 * intersection >= percent * union
    region_shingles: int = 4 << 20   # a region with more is cut into blocks, a task for each pair of them
    cell_members: int = 192    # a region of fewer is not split into cells
    pivots: int = 6
    count_links: bool = True   # else only the classes are told: sets of one class are not compared further


def bands(percent: int, limit: int) -> np.ndarray:
    """First sizes of the bands; sizes of linked sets are in one band or in neighbours."""
    first = [1]
    while first[-1] <= limit:
        first.append(first[-1] * 100 // percent + 1)
    return np.array(first + [first[-1] * 100 // percent + 1], np.int64)


def parts_of(first: np.ndarray, percent: int):
    """Per band: D (most differences of a linked pair with a set in the band) and K parts."""
    top = first[1:] - 1
    most = top + top * 100 // percent
    d = most * (100 - percent) // (100 + percent)
    return d, d + 1 + (d * 12 + 99) // 100 + 2


def ranged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of many runs, one after another."""
    shift = starts - (np.cumsum(counts) - counts)
    return np.repeat(shift, counts) + np.arange(int(counts.sum()))


def set_ids(doc: np.ndarray, value: np.ndarray, n_docs: int):
    """(sizes, 64-bit id) of every doc's set; sorted (doc, value) in."""
    n = np.bincount(doc, minlength=n_docs)
    total = np.zeros(len(value) + 1, W.U)
    np.cumsum(value, out=total[1:], dtype=W.U)
    end = np.cumsum(n)
    return n, W.mix((total[end] - total[end - n]) ^ W.mix(n.astype(W.U)))


class Common:
    """The broadcast table of common shingles with the sets they were seen in.

    It decides which parts tie sets together, never which sets are linked, so
    it may be cut at its bound.
    """

    def __init__(self, shingle: np.ndarray, seen: np.ndarray):
        order = np.argsort(shingle)
        self.shingle, self.seen = shingle[order], seen[order]

    def of(self, value: np.ndarray) -> np.ndarray:
        """Sets seen for every shingle, 0 for one that is not common."""
        if not len(self.shingle):
            return np.zeros(len(value), np.int64)
        at = np.minimum(np.searchsorted(self.shingle, value), len(self.shingle) - 1)
        return np.where(self.shingle[at] == value, self.seen[at], 0)


NOTHING = Common(np.zeros(0, W.U), np.zeros(0, np.int64))


def ties(doc: np.ndarray, value: np.ndarray, n: np.ndarray, percent: int, common: Common = NOTHING):
    """(doc, signature): linked sets have a signature in common.

    Parts hold only shingles that are not common: the sets without them differ
    in no more than the whole sets do, and a passage that thousands of texts
    share ties none of them.
    """
    first = bands(percent, int(n.max(initial=1)))
    d_of, k_of = parts_of(first, percent)
    band = np.searchsorted(first, n, "right") - 1
    start = np.cumsum(n) - n
    seen = common.of(value)
    rare = seen == 0
    docs, signatures = [], []
    for lower in (0, 1):                       # the set's own ring, and the ring below as its window
        ring = band - lower
        use = (n > 0) & (ring >= 0)
        k = np.where(use, k_of[np.maximum(ring, 0)], 0)
        mine = use[doc] & rare
        own, v = doc[mine], value[mine]
        base = np.cumsum(k) - k
        part = ((v >> W.U(32)) * k[own].astype(W.U) >> W.U(32)).astype(np.int64)
        cell = base[own] + part
        cells = int(k.sum())
        low = np.bincount(cell, weights=(v & W.U(0xFFFFFFFF)).astype(np.float64), minlength=cells)
        high = np.bincount(cell, weights=(v >> W.U(32)).astype(np.float64), minlength=cells)
        filled = np.flatnonzero(np.bincount(cell, minlength=cells))
        owner = np.repeat(np.arange(len(n)), k)[filled]
        content = low[filled].astype(W.U) + (high[filled].astype(W.U) << W.U(32))
        tag = ((filled - base[owner]).astype(W.U) << W.U(16)) + ring[owner].astype(W.U)
        docs.append(owner)
        signatures.append(W.mix(content ^ W.mix(tag)))
        # too many empty parts: the agreeing ones might all be empty, so tie by least shingles
        # too (in the order of how many sets they were seen in)
        empty = k - np.bincount(owner, minlength=len(n))
        weak = np.flatnonzero(use & (empty >= k - d_of[np.maximum(ring, 0)]))
        if len(weak):
            at = ranged(start[weak], n[weak])
            at = at[np.lexsort((value[at], seen[at], doc[at]))]
            lead = n[weak] - -(-n[weak] * percent // 100) + 1
            at = at[ranged(np.cumsum(n[weak]) - n[weak], lead)]
            docs.append(doc[at])
            signatures.append(W.mix(value[at] ^ W.mix(ring[doc[at]].astype(W.U) + W.U(1 << 40))))
    return np.concatenate(docs), np.concatenate(signatures)


def _list(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))


class Region:
    """The sets of one region, for exact distances inside one task."""

    def __init__(self, sizes: np.ndarray, values: np.ndarray, weight: np.ndarray, percent: int, count_links: bool = True):
        self.n, self.weight, self.percent, self.count_links = sizes.astype(np.int64), weight, percent, count_links
        self.end = np.cumsum(self.n)
        self.token = np.unique(values, return_inverse=True)[1].astype(np.int64)
        self.mark = np.zeros(int(self.token.max(initial=0)) + 1, bool)
        self.root = np.arange(len(sizes))
        self.links = np.zeros(len(sizes), np.int64)     # rows linked to a set, its own rows too

    def shares(self, p: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of intersection and union of p with the members of ``among``."""
        own = self.token[self.end[p] - self.n[p]:self.end[p]]
        self.mark[own] = True
        n = self.n[among]
        hits = self.mark[self.token[ranged(self.end[among] - n, n)]]
        self.mark[own] = False
        total = np.zeros(len(hits) + 1, np.int64)
        np.cumsum(hits, out=total[1:])
        end = np.cumsum(n)
        inter = total[end] - total[end - n]
        return inter, n + self.n[p] - inter

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def unite(self, p: int, others) -> None:
        for x in others[self.root[others] != self.root[p]]:
            a, b = self.find(p), self.find(int(x))
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.root[int(x)] = min(a, b)

    def compare(self, home: np.ndarray, alive: np.ndarray) -> None:
        """Links of every set of ``home`` with those of ``alive``."""
        alive = alive[np.argsort(self.n[alive], kind="stable")]
        sizes = self.n[alive]
        low = np.searchsorted(sizes, -(-self.n[home] * self.percent // 100))
        high = np.searchsorted(sizes, self.n[home] * 100 // self.percent, "right")
        for p, a, b in zip(home.tolist(), low.tolist(), high.tolist()):
            among = alive[a:b]
            if not self.count_links:        # what is known to be of one class adds nothing
                among = among[self.root[among] != self.find(p)]
            inter, union = self.shares(p, among)
            linked = among[100 * inter >= self.percent * union]
            self.links[p] += self.weight[linked].sum()
            self.unite(p, linked)

    def join(self, home: np.ndarray, alive: np.ndarray, cell_members: int, pivots: int) -> None:
        """Voronoi cells with windows while they get smaller, then sets one by one."""
        if len(alive) <= cell_members or not len(home):
            self.compare(home, alive)
            return
        every = np.union1d(home, alive)
        chosen, distance = [int(every[0])], []
        for _ in range(pivots):
            inter, union = self.shares(chosen[-1], every)
            distance.append(1.0 - inter / union)
            chosen.append(int(every[np.argmax(np.min(distance, axis=0))]))   # farthest from all so far
        distance = np.array(distance)
        own = np.argmin(distance, axis=0)[np.searchsorted(every, home)]
        # 2e-9 covers the rounding of the quotients
        window = (distance - distance.min(axis=0) <= 2 * (100 - self.percent) / 100 + 2e-9)[:, np.searchsorted(every, alive)]
        if window.sum(axis=1).max() > 0.7 * len(alive):
            self.compare(home, alive)
            return
        for k, cell in enumerate(window):
            self.join(home[own == k], alive[cell], cell_members, pivots)


def region_links(table: pa.Table, settings: Settings) -> pa.Table:
    """(a, b, links): every member with the least member it is linked to, directly or over others,
    and for those of the home block the rows of the other block it is linked to."""
    table = table.combine_chunks()
    ids = table.column("set_id").to_numpy()
    lists = table.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    region = Region(sizes, lists.flatten().to_numpy(), table.column("weight").to_numpy(), settings.percent,
                    settings.count_links)
    home, other = (table.column(c).to_numpy(zero_copy_only=False) for c in ("home", "other"))
    region.join(np.flatnonzero(home), np.flatnonzero(other), settings.cell_members, settings.pivots)
    roots = np.array([region.find(x) for x in range(len(ids))], np.int64)
    tell = home | (roots != np.arange(len(ids)))
    return pa.table({"a": pa.array(ids[tell]), "b": pa.array(ids[roots[tell]]), "links": pa.array(region.links[tell])})


def blocks(members: DataFrame, settings: Settings) -> DataFrame:
    """Members dealt to tasks: region, home_block, other_block, and whether a row is of either block.

    ``members`` has region, set_id, n, weight, shingles.  A region that fits a task is one block.
    """
    sizes = members.groupBy("region").agg(F.sum("n").alias("shingle_sum"))
    big = written(sizes.filter(F.col("shingle_sum") > settings.region_shingles).select(
        F.col("region").alias("big"), F.ceil(2 * F.col("shingle_sum") / settings.region_shingles).cast("int").alias("cuts")),
        "join-big")
    cut = members.join(big, members["region"] == big["big"], "left").select(
        "region", "set_id", "weight", "shingles", F.coalesce("cuts", F.lit(1)).alias("cuts"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("cuts").cast("long")).cast("int"))
    mate = cut.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    as_home = mate.select("region", F.col("block").alias("home_block"), F.col("mate").alias("other_block"), "set_id", "weight",
                          "shingles", F.lit(True).alias("home"), (F.col("block") == F.col("mate")).alias("other"))
    as_other = mate.filter("block != mate").select(
        "region", F.col("mate").alias("home_block"), F.col("block").alias("other_block"), "set_id", "weight", "shingles",
        F.lit(False).alias("home"), F.lit(True).alias("other"))
    return as_home.unionByName(as_other)


def sets_and_common(docs: DataFrame, settings: Settings, keep: tuple[str, ...] = ()) -> tuple[DataFrame, Common]:
    """doc_id, n_shingles, set_id, n_words and the ``keep`` columns of every row, and the ``COMMON_MOST`` most
    frequent of the shingles that several distinct sets of a block share.  One pass over the texts tells both."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.select("doc_id", *keep).schema}
    def run(batches):
        held, size, ids_seen = [], 0, np.zeros(0, W.U)

        def told(parts, own):
            shingle, sets = np.unique(np.concatenate(parts), return_counts=True)
            often = sets >= COMMON_LEAST
            shingle, sets = pa.array(shingle[often].view(np.int64)), pa.array(sets[often])
            gone = [pa.nulls(len(shingle), t) for t in (*own, pa.int64(), pa.int64(), pa.int64())]
            return pa.RecordBatch.from_arrays([*gone, shingle, sets], columns)

        columns, kind = [*kinds, "n_shingles", "set_id", "n_words", "shingle", "seen"], None
        for batch in batches:
            kind = [batch.schema.field(c).type for c in kinds]
            for part in W.slices(batch):
                w = W.words(part.column("text"), lower=True)
                doc, value = W.shingles(w, part.num_rows, settings.size)
                n, ids = set_ids(doc, value, part.num_rows)
                none = pa.nulls(part.num_rows, pa.int64())
                n_words = np.bincount(w.doc, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kinds), pa.array(n, pa.int64()),
                                                  pa.array(ids.view(np.int64)), pa.array(n_words, pa.int64()), none, none], columns)
                # rows without id link nothing
                has_id = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                at = np.flatnonzero(has_id)
                fresh = np.zeros(part.num_rows, bool)
                fresh[at[np.unique(ids[at], return_index=True)[1]]] = True
                fresh &= ~np.isin(ids, ids_seen)
                ids_seen = np.concatenate([ids_seen, ids[fresh]])
                held.append(value[fresh[doc]])
                size += len(held[-1])
                if size >= COMMON_BLOCK:
                    yield told(held, kind)
                    held, size, ids_seen = [], 0, np.zeros(0, W.U)
        if size:
            yield told(held, kind)

    own = ", ".join(f"`{c}` {t}" for c, t in kinds.items())
    both = written(docs.select("doc_id", *keep, "text").mapInArrow(
        run, f"{own}, n_shingles long, set_id long, n_words long, shingle long, seen long"), "join-sets")
    named = both.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    most = named.orderBy(F.desc("seen"), "shingle").limit(COMMON_MOST).toPandas()
    common = Common(most["shingle"].to_numpy(np.int64).view(W.U), most["seen"].to_numpy(np.int64))
    return both.filter("shingle IS NULL").select(*kinds, "n_shingles", "set_id", "n_words"), common


def tied(docs: DataFrame, common: Common, settings: Settings) -> DataFrame:
    """(a, b): sets that agree on a part, each with the least of those that agree."""
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    # plain arrays: workers need no copy of this package to unpickle them
    shared = spark.sparkContext.broadcast((common.shingle, common.seen))

    def deal(ids, doc, signature):
        bucket = (signature >> W.U(40)).astype(np.int64) % buckets
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        used, counts = np.unique(bucket, return_counts=True)
        edges = np.append(0, np.cumsum(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), _list(signature[order].view(np.int64), edges), _list(ids[doc[order]], edges)],
            ["bucket", "signature", "set_id"])

    def run(batches):
        held, size, seen = [], 0, np.zeros(0, np.int64)
        often = Common(*shared.value)
        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"), lower=True)
                doc, value = W.shingles(w, part.num_rows, settings.size)
                n, ids = set_ids(doc, value, part.num_rows)
                ids = ids.view(np.int64)
                # one of equal sets is enough
                fresh = np.zeros(part.num_rows, bool)
                fresh[np.unique(ids, return_index=True)[1]] = True
                fresh &= ~np.isin(ids, seen)
                use = fresh[doc]
                n = np.where(fresh, n, 0)
                d, s = ties(doc[use], value[use], n, settings.percent, often)
                held.append((ids[d], s))
                seen = np.concatenate([seen, ids[fresh]])
                size += len(d)
                if size >= BLOCK:
                    i, s = (np.concatenate(x) for x in zip(*held))
                    yield deal(i, np.arange(len(i)), s)
                    held, size, seen = [], 0, seen[-50_000:]
        if size:
            i, s = (np.concatenate(x) for x in zip(*held))
            yield deal(i, np.arange(len(i)), s)

    blocks = docs.select("doc_id", "text").mapInArrow(run, "bucket int, signature array<long>, set_id array<long>")

    def meet(table: pa.Table) -> pa.Table:
        s, i = (np.concatenate([c.flatten().to_numpy() for c in table.column(name).chunks])
                for name in ("signature", "set_id"))
        order = np.argsort(s)
        s, i = s[order], i[order]
        start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        least = np.minimum.reduceat(i, start)
        least = np.repeat(least, np.diff(np.append(start, len(s))))
        other = i != least
        pairs = np.unique(np.stack([i[other], least[other]], axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return blocks.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def join(docs: DataFrame, settings: Settings = Settings(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), n_links (other rows
    linked to directly; without ``count_links`` null) of every row; with ``keep`` these columns and
    n_words as well."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    measured, common = sets_and_common(docs, settings, keep)
    also = [*keep, "n_words"] if keep else []
    named = measured.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # rows without id link nothing: they must not stand for the equal sets of rows that have one
    region_of = components(tied(docs.filter("doc_id IS NOT NULL"), common, settings))
    first = named.groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    wanted = written(region_of.join(first, region_of["node"] == first["set_id"])
                     .select(F.col("root").alias("region"), "set_id", "first_id", "weight"), "join-regions")

    def gather(batches):
        for batch in batches:
            for part in W.slices(batch):
                w = W.words(part.column("text"), lower=True)
                doc, value = W.shingles(w, part.num_rows, settings.size)
                n, ids = set_ids(doc, value, part.num_rows)
                lists = _list(value.view(np.int64), np.append(0, np.cumsum(n)))
                right = pa.array(ids.view(np.int64) == part.column("set_id").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [part.column("region"), part.column("set_id"), pa.array(n, pa.int64()), part.column("weight"), lists],
                    ["region", "set_id", "n", "weight", "shingles"]).filter(right)

    texts = docs.select("doc_id", "text")
    if wanted.count() <= BROADCAST_ROWS:       # else both sides are shuffled
        wanted = F.broadcast(wanted)
    members = (texts.join(wanted, texts["doc_id"] == wanted["first_id"]).select("region", "set_id", "weight", "text")
               .mapInArrow(gather, "region long, set_id long, n long, weight long, shingles array<long>"))
    members = written(members.dropDuplicates(["set_id"]), "join-members")
    found = written(blocks(members, settings).groupBy("region", "home_block", "other_block").applyInArrow(
        lambda t: region_links(t, settings), "a long, b long, links long"), "join-links")
    root_of = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("linked")).agg(F.sum("links").alias("links"))
    group = first.select(F.col("set_id").alias("set"), "weight")
    classes = written(group.join(root_of, group["set"] == root_of["node"], "left").join(links, group["set"] == links["linked"], "left")
                      .select("set", F.coalesce("root", "set").alias("class_id"),
                              (F.coalesce("links", "weight") - 1 if settings.count_links else F.lit(None).cast("long")).alias("n_links")),
                      "join-sets-linked")
    keyed = written(named.join(classes, named["set_id"] == classes["set"])
                    .select("doc_id", "n_shingles", "class_id", "n_links", *also), "join-classes")
    least = written(keyed.groupBy("class_id").agg(F.min("doc_id").alias("component_id"))
                    .select(F.col("class_id").alias("class"), "component_id"), "join-least")
    # both sides are exchanged for this join, so the rows of a hot class can be split
    whole = keyed.join(least, keyed["class_id"] == least["class"]).select("doc_id", "n_shingles", "component_id", "n_links", *also)
    alone = measured.filter("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).cast(kind).alias("component_id"),
        F.lit(0 if settings.count_links else None).cast("long").alias("n_links"), *also)
    return whole.unionByName(alone)


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each group of linked ones (the least id) with all columns; rows without an id stay.

    Rows are told apart by id and text: an id that comes again with a text of its own loses only the row that is linked.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    told = join(docs.select("doc_id", "text", text_hash.alias("text_hash")), replace(settings, count_links=False), ("text_hash",))
    drop = (told.filter("component_id IS NOT NULL AND component_id != doc_id")
            .select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_text")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_hash.alias("hash"))
    return rows.join(drop, (F.col("id") == F.col("dropped_id")) & (F.col("hash") == F.col("dropped_text")), "left_anti").select("row.*")
