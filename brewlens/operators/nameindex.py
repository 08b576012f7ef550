"""A stored index of known names for the similarity join, so that linking new
mentions or entities tokenises the new names only.

Under ``path``:

* ``prefixes``: (tok, key) of the signatures of every key, the hashes of the key itself and of the key less one
  character, partitioned by the token's bucket; a search reads the buckets of its own tokens.  Append only.
* ``keys``: a keyed table (key -> entity_id, entity_type, pos_id, pos_p).

Most names that match at all share a signature with their match, and these are settled by the filed rows alone.
Only names that found nothing so near are compared further, with the keys (:func:`brewlens.operators.link.nearest`).

``add`` files the entries that are new or changed.  Prefixes go first and keys
last, so a run that was lost half-way is repeated: what it filed twice is
folded when it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brewlens.functions import text as T
from brewlens.operators import link as L
from brewlens.operators.keyed import KeyedTable
from brewlens.session import merging, scratch_path

TOKEN_BUCKET = "tok_bucket"
_CACHE = ["key", "entity_id", "entity_type", "pos_id", "pos_p"]
_SETTINGS = "buckets int"
LONGEST = L.MAX_SIGNATURES      # longer names are compared with the keys themselves


class NameIndex:
    """Open the index under ``path``; :meth:`create` makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.buckets = spark.read.schema(_SETTINGS).json(f"{path}/_layout").first()["buckets"]
        self.keys = KeyedTable(spark, f"{path}/keys")

    @classmethod
    def create(cls, cache: DataFrame, path: str, buckets: int = 64) -> NameIndex:
        """An index of ``cache`` (:func:`brewlens.operators.link.entity_cache`)."""
        spark = cache.sparkSession
        spark.createDataFrame([(buckets,)], _SETTINGS).coalesce(1).write.json(f"{path}/_layout")
        held = _held(cache.select(*_CACHE), "name-index")
        KeyedTable.create(held.limit(0), f"{path}/keys", ["key"], buckets)
        spark.createDataFrame([], f"tok string, key string, {TOKEN_BUCKET} int").write.partitionBy(TOKEN_BUCKET).parquet(f"{path}/prefixes")
        index = cls(spark, path)
        index.add(held)
        return index

    def add(self, cache: DataFrame) -> int:
        """File entries; returns how many keys were tokenised (those the index lacked).

        A known key takes the new entity and type and keeps its place, as in a cache built at once.
        """
        held = _held(cache.select(*_CACHE), "name-entries")
        touched = [r[0] for r in held.select(_bucket("key", self.keys.buckets)).distinct().collect()]
        known = self.keys._stored(touched).select("key")
        fresh = _held(held.join(merging(known), "key", "left_anti").select("key"), "name-fresh")
        added = fresh.count()
        if added:
            filed = _tokens(fresh).withColumn(TOKEN_BUCKET, _bucket("tok", self.buckets))
            (filed.select("tok", "key", TOKEN_BUCKET).repartition(self.buckets, TOKEN_BUCKET)
             .write.mode("append").partitionBy(TOKEN_BUCKET).parquet(f"{self.path}/prefixes"))
        self.keys.upsert_into(held, ["entity_id", "entity_type"], ["pos_id", "pos_p"])
        return added

    def candidates(self, names: DataFrame) -> DataFrame:
        """(lid, rid): each name (``key``) with the filed keys that may have a ratio above the threshold."""
        return L.similarity_candidates(names.select(F.col("key").alias("lid"), F.col("key").alias("lstr")).distinct(),
                                       self.keys.read().select(F.col("key").alias("rid"), F.col("key").alias("rstr")))

    def _close(self, names: DataFrame) -> DataFrame:
        """(lid, rid): each name (``key``) with the filed keys that share a signature with it."""
        mine = _held(_tokens(names.select("key").distinct()).withColumn(TOKEN_BUCKET, _bucket("tok", self.buckets)),
                     "name-probes")
        touched = [r[0] for r in mine.select(TOKEN_BUCKET).distinct().collect()]      # at most `buckets` numbers
        filed = (self.spark.read.schema(f"tok string, key string, {TOKEN_BUCKET} int").parquet(f"{self.path}/prefixes")
                 .where(F.col(TOKEN_BUCKET).isin(touched)).select("tok", F.col("key").alias("rid")))
        return mine.select("tok", F.col("key").alias("lid")).join(merging(filed), "tok").select("lid", "rid").distinct()

    def match(self, probes: DataFrame) -> DataFrame:
        """The same as :func:`brewlens.operators.link.match_entities`, from the stored index:
        (probe_id, entity_id, method, ratio) of the probes (probe_id, name, entity_type) that match."""
        p = probes.select("probe_id", "entity_type", T.normalize_name("name").alias("norm"))
        names = _held(p.select("entity_type", "norm").distinct(), "name-asked")
        keys = self.keys.read()
        exact = names.join(merging(keys.select(F.col("key").alias("norm"), "entity_id")), "norm").select(
            "entity_type", "norm", "entity_id", F.lit("exact").alias("method"), F.lit(1.0).alias("ratio"))
        rest = names.join(merging(keys.select(F.col("key").alias("norm"))), "norm", "left_anti")
        rest = _held(rest, "name-rest")
        pick = F.max_by(F.struct("entity_id", "ratio"), F.struct(F.col("ratio"), -F.col("pos_id"), -F.col("pos_p")))
        pairs = _held(self._close(rest.select(F.col("norm").alias("key"))), "name-candidates")
        scored = L.scored_pairs(pairs, pairs.select("lid", F.col("lid").alias("lstr")).distinct(),
                                pairs.select("rid", F.col("rid").alias("rstr")).distinct())
        found = (scored.join(merging(keys.select(F.col("key").alias("rid"), "entity_id", "entity_type", "pos_id", "pos_p")), "rid")
                 .join(merging(rest.select("entity_type", F.col("norm").alias("lid"))), ["entity_type", "lid"]))
        close = found.groupBy("entity_type", F.col("lid").alias("norm")).agg(pick.alias("b"))
        # two names of n and other characters without a common signature have a ratio of n / (n + 1) at most
        n = F.length("norm")
        close = _held(close.where((F.col("b.ratio") > n / (n + 1)) & (n <= LONGEST - 2)), "name-close")
        left = _held(rest.join(merging(close), ["entity_type", "norm"], "left_anti").select(
            F.concat_ws("\u0002", "entity_type", "norm").alias("lid"), F.col("norm").alias("lstr"),
            F.col("entity_type").alias("blk"), F.lit(0.0).alias("floor")), "name-open")
        right = keys.select(F.col("key").alias("rid"), F.col("key").alias("rstr"), F.col("entity_type").alias("blk"),
                            "entity_id", "pos_id", "pos_p")
        far = L.nearest(left, right, pick, block="blk", tiers=L.TIERS[1:]).join(merging(left), "lid").select(
            F.col("blk").alias("entity_type"), F.col("lstr").alias("norm"), "b")
        fuzzy = close.unionByName(far).select("entity_type", "norm", F.col("b.entity_id").alias("entity_id"),
                                              F.lit("fuzzy").alias("method"), F.col("b.ratio").alias("ratio"))
        return p.join(merging(exact.unionByName(fuzzy)), ["entity_type", "norm"]).select("probe_id", "entity_id", "method", "ratio")


def _bucket(column: str, buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def _tokens(names: DataFrame) -> DataFrame:
    """(key, tok): the signatures of each name of at most ``LONGEST`` characters, itself and less one."""
    wanted = {n: [n, n - 1] for n in L._lengths(names, "key") if n <= LONGEST}
    return L._signatures(names.select("key", F.col("key").alias("text")), "text", wanted).select(
        "key", F.col("sig").cast("string").alias("tok"))


def _held(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
