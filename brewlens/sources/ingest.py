"""Landing and reading raw records: dated JSON files, forum posts, pages.

Schemas are explicit (never inferred).  Landed files are partitioned by
source and day; re-landing a day replaces that partition only (dynamic
partition overwrite), like the per-day JSON files of the original collectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brewlens.operators.upsert import insert_ignore

# JSON timestamps keep microseconds (Spark's default pattern stops at milliseconds)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

COMMENT = T.StructType([
    T.StructField("body", T.StringType()), T.StructField("score", T.IntegerType()),
    T.StructField("created_utc", T.StringType())])

DISCUSSION = T.StructType([
    T.StructField("post_id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("author", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("upvote_ratio", T.DoubleType()),
    T.StructField("num_comments", T.LongType()), T.StructField("created_utc", T.DoubleType()),
    T.StructField("url", T.StringType()), T.StructField("subreddit", T.StringType()),
    T.StructField("top_comments", T.ArrayType(COMMENT)), T.StructField("flair", T.StringType()),
    T.StructField("scraped_date", T.StringType()), T.StructField("mentioned_drinks", T.ArrayType(T.StringType()))])

RAW_POSTS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("body", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("author", T.StringType()),
    T.StructField("posted_at", T.TimestampType()), T.StructField("metadata", T.StringType()),
    T.StructField("scraped_at", T.TimestampType())])


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = DISCUSSION,
                      multiline: bool = False) -> DataFrame:
    """Read landed JSON (one record per line, or whole-array files with
    ``multiline``) with its file path, for newest-per-source selection."""
    r = spark.read.schema(schema)
    if multiline:
        r = r.option("multiLine", True)
    return r.json(path).withColumn("_file", F.col("_metadata.file_path"))


def newest_file_per_source(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows of the newest landed file of each source (file names carry the date)."""
    newest = df.groupBy(source_col).agg(F.max("_file").alias("_file"))
    return df.join(newest, [source_col, "_file"], "left_semi")


def land_json(df: DataFrame, path: str, source_col: str, day_col: str) -> None:
    """Write records as JSON partitioned by source and day, replacing only the
    partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(source_col, day_col).json(path))


def discussions_to_raw_posts(d: DataFrame, scraped_at=None) -> DataFrame:
    """Forum discussions -> raw_posts rows with the original defaults:
    author '[deleted]' when missing, body '' when missing, source 'reddit',
    epoch seconds -> timestamp, absolute permalink."""
    url = F.when(F.col("url").startswith("http"), F.col("url")) \
        .otherwise(F.concat(F.lit("https://reddit.com"), F.coalesce("url", F.lit(""))))
    return d.select(
        F.col("post_id").alias("id"), F.lit("reddit").alias("source"), F.col("title"),
        F.coalesce("text", F.lit("")).alias("body"), url.alias("url"),
        F.coalesce("author", F.lit("[deleted]")).alias("author"),
        F.timestamp_seconds("created_utc").alias("posted_at"),
        F.lit(None).cast("string").alias("metadata"),
        (F.current_timestamp() if scraped_at is None else F.lit(scraped_at).cast("timestamp")).alias("scraped_at"))


def save_posts(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``INSERT ... ON CONFLICT (id) DO NOTHING`` of a batch of raw posts
    (first row per id in the batch wins)."""
    b = batch.withColumn("_seq", F.monotonically_increasing_id())
    return insert_ignore(target, b, ["id"], ["_seq"])
