"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is an external Parquet table, one row per distinct text:
``digest`` (SHA-256 hex of the text), ``keep_id`` and ``group_size``.  A batch
is reduced to one row per digest (partial aggregation first, so a text that
makes up a third of the rows is folded before the shuffle), anti-joined with
the index by sort-merge, and the rest is appended.  Decisions are then looked
up in the index, so running a batch twice gives the same decisions and adds
nothing.

The layout (number of buckets, type of the id) is written beside the index
when it is made.  Whoever opens it later takes the layout from there, whatever
its own session's settings, and an id of another type is refused: files
bucketed in two ways would let known texts in again.

Defined cases: null text counts as empty; a null id never beats another id,
and where all rows of a group lack an id they all stay; rows repeating id and
text are one document (the same decision on each, ``deduplicate`` returns one);
an empty table gives no rows; columns besides doc_id and text ride along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brewlens.llm.common import shuffle_partitions, written
from brewlens.session import path_exists, scratch_path


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and digest of every row; texts are compared as they are."""
    return docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))


class DigestIndex:
    """The index under ``path``; opening it again (any session) finds what was appended.

    ``buckets`` only counts when the index is first made: choose it for the size
    the index will reach (about 128 MB of digests a bucket).  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 16):
        self.spark, self.path = spark, path
        layout = self._layout(id_type, buckets)
        if layout["id_type"] != id_type:
            raise ValueError(f"the index at {path} has ids of type {layout['id_type']}, not {id_type}")
        self.buckets = layout["buckets"]
        # a name of our own: another session or an earlier opening may have said something else about the path
        self.name = "digest_index_" + uuid.uuid4().hex[:16]
        spark.sql(f"CREATE TABLE {self.name} (digest STRING, keep_id {id_type}, group_size BIGINT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}/digests'")

    def _layout(self, id_type: str, buckets: int) -> dict:
        """The layout written beside the digests; a new index gets the one asked for."""
        if not path_exists(self.spark, f"{self.path}/layout/_SUCCESS"):
            self.spark.createDataFrame([(id_type, buckets)], "id_type string, buckets int").coalesce(1).write.mode("overwrite").json(f"{self.path}/layout")
        return self.spark.read.schema("id_type string, buckets int").json(f"{self.path}/layout").first().asDict()

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, docs: DataFrame) -> None:
        """Add the digests that the index lacks; of equal new texts the largest id stays."""
        once = digests(docs).groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        groups = once.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
        # bucketed and sorted on this side, so a merge reads the index without exchanging it
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest")
         .write.insertInto(self.name))

    def decide(self, docs: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 for every row.

        The index is read as plain files here: with an exchange on both sides
        adaptive execution can split the rows of a hot digest.
        """
        self.spark.catalog.refreshTable(self.name)
        index = self.spark.read.schema(self.table().schema).parquet(f"{self.path}/digests")
        joined = digests(docs).join(index.hint("merge"), "digest")
        return joined.select("doc_id", "keep_id", "group_size",
                             F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                             F.col("digest").alias("text_sha256"))

    def close(self) -> None:
        """Forget the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def decisions(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Append ``docs`` to the index at ``path`` (a fresh one if not given) and decide each row."""
    spark = docs.sparkSession
    index = DigestIndex(spark, path or scratch_path(spark, "digest-index"), dict(docs.dtypes)["doc_id"],
                        max(8, shuffle_partitions(spark)))
    try:
        index.append(docs)
        return index.decide(docs)
    finally:
        index.close()


def _row_key(doc_id: Column, digest: Column) -> Column:
    return F.concat(F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("null")), F.lit(":"), digest)


def deduplicate(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The rows that stay, with all their columns, one for each text.

    Of the rows of a text the kept id's stays; should several rows repeat id and text, one of them
    does.  The rows are exchanged once, by id and digest, so copies of one text are not gathered.
    """
    decided = decisions(docs, path)
    # only what does not simply stay: ids that lose, and ids that repeat their text
    told = decided.groupBy(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("key")).agg(
        F.first("kept").alias("stays"), F.count(F.lit(1)).alias("rows"), F.first("doc_id").alias("id"))
    told = written(told.filter("NOT stays OR (rows > 1 AND id IS NOT NULL)").select("key", "stays"), "digest-dropped")
    rows = docs.select(F.struct("*").alias("row"),
                       _row_key(F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key"))
    joined = rows.join(told.hint("merge"), "key", "left").withColumn(
        "copy", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1))))
    return joined.filter("stays IS NULL OR (stays AND copy = 1)").select("row.*")
