"""Best-fit packing of documents into fixed-length sequences, under conflicts.

Documents are dealt by hash into shards of a few thousand; a shard is packed
by best-fit decreasing.  A bin carries two bitmaps: places taken per source
(at most ``per_source`` documents of one source share a bin) and the duplicate
clusters it holds (texts of one cluster never share a bin; by default that is
copies of one text, with ``near_clusters`` all near copies).  Open bins are kept
in the order of their room left; an item starts at the successor of its own
size and walks on until a bin is compatible, which is then the tightest one.

A text longer than a bin fills whole bins; its rest is packed as an item.

Packing shuffles ids, lengths, sources and cluster ids only; ``near_clusters``
also what the n-gram join shuffles (shingle hashes, and the texts of sets that have a tie).  A
source or cluster with a third of all rows is spread over all shards by the
hash, and no group is gathered.

Defined cases: null text is empty (one end token); null source is a source of
its own; equal ids are packed as separate rows; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brewlens.llm import ngram_join
from brewlens.llm.common import prepare, written
from brewlens.llm.mixing import n_words

CAPACITY = 4096
PER_SOURCE = 8
SHARD_DOCS = 4096


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def near_clusters(docs: DataFrame, settings: ngram_join.Settings = ngram_join.Settings(count_links=False)) -> DataFrame:
    """doc_id, n_tokens, source, near_cluster of every document: the least text hash of its class in the
    n-gram join.  Texts are named by their hash there, so rows without id or with equal ids have their class;
    ids, sources and word counts come along, and no further pass reads the texts."""
    named = ngram_join.join(docs.select(text_hash().alias("doc_id"), F.col("doc_id").alias("own_id"), "source", "text"),
                            settings, keep=("own_id", "source"))
    return named.select(F.col("own_id").alias("doc_id"), (F.col("n_words") + 1).alias("n_tokens"), "source",
                        F.col("component_id").alias("near_cluster"))


def items(docs: DataFrame, cluster: str | None = None) -> DataFrame:
    """doc_id, n_tokens (words and an end token), source, cluster of every document.

    ``cluster`` names the column that holds it (null: conflicts with nothing); by default it is
    the hash of the text.  Without a text column ``docs`` has n_tokens.
    """
    n = (n_words(F.col("text")) + 1).alias("n_tokens") if "text" in docs.columns else F.col("n_tokens")
    return docs.select("doc_id", n, "source", (text_hash() if cluster is None else F.col(cluster)).alias("cluster"))


def best_fit(sized: list[tuple[int, int, int]], capacity: int, per_source: int) -> list[int]:
    """Bin of every (size, source number, cluster number) item, taken in the order given.

    A cluster number below 0 conflicts with nothing.  Ties in room go to the
    bin opened first.
    """
    order: list[tuple[int, int]] = []      # (room left, bin), ascending
    sources: list[int] = []                # per bin: per_source bits for each source, filled from below
    clusters: list[int] = []               # per bin: a bit for each cluster
    where = []
    full = (1 << per_source) - 1
    for size, source, cluster in sized:
        shift, copy = source * per_source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and ((sources[order[at][1]] >> shift) & full == full or clusters[order[at][1]] & copy):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        taken = (sources[b] >> shift) & full
        sources[b] |= (taken + 1) << shift
        clusters[b] |= copy
        if room > size:
            insort(order, (room - size, b))
        where.append(b)
    return where


def pack(sized: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: bin_id, doc_id, piece, start, n_tokens, source, cluster.

    ``sized`` has doc_id, n_tokens, source, cluster.  bin_id is the shard and
    the bin's number in it (``shard * 2**32 + bin``).
    """
    spark = sized.sparkSession
    prepare(spark)
    shards = max(1, -(-sized.count() // shard_docs))
    kind = dict(sized.dtypes)["doc_id"]
    dealt = (sized.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "source",
                          F.col("cluster").cast("long").alias("cluster"))
             .withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "n_tokens"), F.lit(shards)).cast("int")))

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["n_tokens"] % capacity, r["cluster"] is None, r["cluster"] or 0, r["source"] or "",
                                 r["doc_id"] is None, r["doc_id"] or 0), reverse=True)
        source_no = {s: k for k, s in enumerate(dict.fromkeys(r["source"] for r in rows))}
        seen: dict = {}
        for r in rows:
            seen[r["cluster"]] = seen.get(r["cluster"], 0) + 1
        cluster_no = {c: k for k, c in enumerate(c for c, n in seen.items() if n > 1 and c is not None)}
        rest = [(r["n_tokens"] % capacity, source_no[r["source"]], cluster_no.get(r["cluster"], -1)) for r in rows]
        where = iter(best_fit([x for x in rest if x[0]], capacity, per_source))
        out: dict[str, list] = {c: [] for c in ("bin_id", "doc_id", "piece", "start", "n_tokens", "source", "cluster")}
        base = rows[0]["shard"] << 32
        used = sum(1 for x in rest if x[0])
        for r, x in zip(rows, rest):
            whole = r["n_tokens"] // capacity
            pieces = [(k, k * capacity, capacity, None) for k in range(whole)]
            if x[0]:
                pieces.append((whole, whole * capacity, x[0], next(where)))
            for piece, start, n, b in pieces:
                if b is None:        # a full bin of its own, numbered after the packed ones
                    b, used = used, used + 1
                for c, v in zip(out, (base + b, r["doc_id"], piece, start, n, r["source"], r["cluster"])):
                    out[c].append(v)
        types = (pa.int64(), table.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(),
                 table.schema.field("source").type, pa.int64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    return dealt.groupBy("shard").applyInArrow(
        run, f"bin_id long, doc_id {kind}, piece int, start long, n_tokens long, source string, cluster long")


def pack_documents(docs: DataFrame, cluster: str | None = None, **options) -> DataFrame:
    # dealt and counted from a written table: the classes are joined once
    return pack(items(docs, cluster) if cluster is None else written(items(docs, cluster), "pack-items"), **options)
