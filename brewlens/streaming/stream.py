"""Structured Streaming: continuous landing and daily partial aggregates.

* ``ingest``: landed JSON files -> ``foreachBatch`` insert-ignore on the key
  into a parquet table.  Exactly-once on the key: a replayed micro-batch finds
  its rows already present and adds nothing.  No watermark here: dropping
  late posts would lose data.
* ``link_stream``: landed posts -> extraction -> the stored tables of linking,
  one named run per micro-batch.
* ``daily_partials``: watermark on event time, 1-day tumbling windows per
  term: count, sentiment sum, +/-0.3 counts, appended when the window closes.
  The 7/30/365-day figures are a batch roll-up of these partials.
* ``merge_partials``: the same daily figures kept in a keyed table, every
  micro-batch added to the days it touches; a row may be any number of days late.
* ``daily_distinct``: first (day, term, post) occurrences via
  ``dropDuplicatesWithinWatermark`` (streaming count-distinct is not
  supported); a batch ``count`` on top gives distinct posts per day.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brewlens.functions import lexicons as LX
from brewlens.operators.keyed import KeyedTable
from brewlens.operators.linkstore import LinkStore
from brewlens.operators.upsert import dedupe
from brewlens.session import path_exists
from brewlens.sources.ingest import TS_FORMAT


def _run(writer, available_now: bool = True):
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        q.awaitTermination()
    return q


def ingest(spark: SparkSession, landing: str, schema: T.StructType, key: list[str], target: str,
           checkpoint: str, order_col: str | None = None, available_now: bool = True,
           max_files_per_trigger: int | None = None, transform=None, buckets: int = 64):
    """Stream landed JSON into ``target`` (parquet), ignoring known keys.

    ``transform`` (DataFrame -> DataFrame, keeping the key columns) runs on the
    new rows of each micro-batch before they are appended: with the batch
    extractor this is the incremental extraction job, whose checkpoint
    replaces the "unprocessed posts" backlog query.

    The target is partitioned by ``key_bucket = pmod(xxhash64(key), buckets)``;
    a micro-batch reads back only the key column of the buckets it touches
    (partition pruning), not the whole table.
    """
    src = spark.readStream.schema(schema).option("timestampFormat", TS_FORMAT)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = src.json(landing)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()       # read twice: for its buckets, then for its rows
        try:
            append(batch)
        finally:
            batch.unpersist()

    def append(batch: DataFrame) -> None:
        b = batch
        if order_col:
            w_first = b.groupBy(*key).agg(F.min_by(F.struct(*[c for c in b.columns]), order_col).alias("_r"))
            b = w_first.select("_r.*")
        else:
            b = dedupe(b, key, [c for c in b.columns if c not in key], keep="first")   # the same row on any cluster
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets))
        b = b.withColumn("key_bucket", bucket)
        touched = [r[0] for r in b.select("key_bucket").distinct().collect()]  # at most `buckets` values
        if not touched:
            return
        try:
            known = (batch.sparkSession.read.parquet(target)
                     .where(F.col("key_bucket").isin(touched)).select("key_bucket", *key))
            b = b.join(known, ["key_bucket", *key], "left_anti")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise                     # only a table that does not exist yet is no error
        if transform is not None:
            b = transform(b.drop("key_bucket")).withColumn("key_bucket", bucket)
        # one writer per touched bucket: keys are unique here, so buckets are even
        b.repartition(len(touched), "key_bucket").write.mode("append").partitionBy("key_bucket").parquet(target)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def link_stream(spark: SparkSession, landing: str, schema: T.StructType, store: str, extract, flavor_terms: DataFrame,
                checkpoint: str, context_chars: int | None = None, available_now: bool = True,
                max_files_per_trigger: int | None = None):
    """Stream landed posts through ``extract`` (posts -> extractions) into the link store at path ``store``.

    A micro-batch is a run named by its id: replayed, its finished plan is applied again, which changes
    nothing.  Entities, origins, mentions and the ledger are carried from batch to batch by the store.
    """
    src = spark.readStream.schema(schema)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)

    def link_batch(batch: DataFrame, batch_id: int) -> None:
        LinkStore(batch.sparkSession, store).link(extract(batch), flavor_terms, f"batch-{batch_id}", context_chars)

    return _run(src.json(landing).writeStream.foreachBatch(link_batch).option("checkpointLocation", checkpoint), available_now)


def _by_day(events: DataFrame, time_col: str, term_col: str, sentiment_col: str) -> DataFrame:
    s = F.col(sentiment_col)
    return (events.groupBy(F.window(time_col, "1 day").alias("w"), F.col(term_col).alias("term"))
            .agg(F.count(F.lit(1)).alias("mention_count"),
                 F.sum(s).alias("sentiment_sum"), F.count(s).alias("sentiment_count"),
                 F.count_if(s > LX.POSITIVE_SENTIMENT).alias("positive_mentions"),
                 F.count_if(s < LX.NEGATIVE_SENTIMENT).alias("negative_mentions"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "term",
                    "mention_count", "sentiment_sum", "sentiment_count", "positive_mentions", "negative_mentions"))


def daily_partials(events: DataFrame, time_col: str = "created_at", term_col: str = "term",
                   sentiment_col: str = "sentiment", delay: str = "1 day") -> DataFrame:
    """Streaming 1-day partial aggregates per term (append when closed)."""
    return _by_day(events.withWatermark(time_col, delay), time_col, term_col, sentiment_col)


PARTIALS = ("day date, term string, mention_count long, sentiment_sum double, sentiment_count long, positive_mentions long, "
            "negative_mentions long, late_mentions long")


def open_partials(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """The keyed table of daily figures per term under ``path``, made empty if it is not there."""
    if not path_exists(spark, f"{path}/partials/data"):
        return KeyedTable.create(spark.createDataFrame([], PARTIALS), f"{path}/partials", ["day", "term"], buckets)
    return KeyedTable(spark, f"{path}/partials")


def merge_batch(batch: DataFrame, run: str, path: str, late_after_days: int = 1) -> None:
    """Add a batch (created_at, term, sentiment) to the daily figures under ``path``.

    What the touched days will hold is computed from the stored figures and written under the run's
    name before it replaces them, so the run repeated by its name changes nothing.  Mentions of days more
    than ``late_after_days`` before the newest day stored are counted as late, and added all the same.
    """
    spark = batch.sparkSession
    table, plan = open_partials(spark, path), f"{path}/runs/{run}"
    if not path_exists(spark, f"{plan}/_SUCCESS"):
        newest = table.read().agg(F.max("day")).first()[0]
        sums = _by_day(batch, "created_at", "term", "sentiment").select(F.to_date("window_start").alias("day"), *[
            c for c in table.schema.names if c not in ("day", "late_mentions")])
        late = F.lit(False) if newest is None else F.col("day") < F.date_sub(F.lit(newest), late_after_days)
        sums = sums.withColumn("late_mentions", F.when(late, F.col("mention_count")).otherwise(0))
        figures = [c for c in table.schema.names if c not in table.keys]
        stored = table.read_for(sums).select(*table.keys, *[F.col(c).alias(f"_{c}") for c in figures])
        joined = sums.join(stored, table.keys, "left")
        joined.select(*table.keys, *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).cast(table.schema[c].dataType).alias(c)
                                     for c in figures]).write.mode("overwrite").parquet(plan)
    table.upsert_into(spark.read.parquet(plan), [c for c in table.schema.names if c not in table.keys])


def merge_partials(events: DataFrame, path: str, checkpoint: str, late_after_days: int = 1, available_now: bool = True):
    """Stream events (created_at, term, sentiment) into the daily figures under ``path``."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, f"batch-{batch_id}", path, late_after_days)

    return _run(events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint), available_now)


def with_open_days(closed: DataFrame, landed: DataFrame, time_col: str = "created_at", term_col: str = "term",
                   sentiment_col: str = "sentiment") -> DataFrame:
    """Closed partials plus those of the days the stream still holds open, from the landed rows."""
    days = closed.select(F.to_date("window_start").alias("_day")).distinct()
    tail = landed.join(days, F.to_date(time_col) == F.col("_day"), "left_anti")
    return closed.unionByName(_by_day(tail, time_col, term_col, sentiment_col).select(closed.columns))


def daily_distinct(events: DataFrame, time_col: str = "created_at", term_col: str = "term",
                   post_col: str = "post_id", delay: str = "1 day") -> DataFrame:
    """First occurrence of each (day, term, post) within the watermark."""
    d = events.withColumn("day", F.to_date(time_col))
    return (d.withWatermark(time_col, delay)
            .dropDuplicatesWithinWatermark(["day", term_col, post_col])
            .select("day", F.col(term_col).alias("term"), F.col(post_col).alias("post_id")))


def write_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    w = df.writeStream.outputMode("append").format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def rollup_partials(partials: DataFrame, as_of: str, days: int) -> DataFrame:
    """Batch roll-up of daily partials into an N-day figure per term."""
    start = F.lit(as_of).cast("date") - F.expr(f"INTERVAL {days} DAYS")
    p = partials.where(F.col("window_start") >= start.cast("timestamp"))
    return p.groupBy("term").agg(
        F.sum("mention_count").alias("mention_count"),
        # a mention without a sentiment counts as a mention only
        (F.sum("sentiment_sum") / F.nullif(F.sum("sentiment_count"), F.lit(0))).alias("avg_sentiment"),
        F.sum("positive_mentions").alias("positive_mentions"),
        F.sum("negative_mentions").alias("negative_mentions"))
