"""Landing/reading JSON and streaming ingest."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from brewlens.sources import ingest as IG
from brewlens.streaming import stream as ST


def test_json_array_file_and_newest_per_source(spark):
    root = tempfile.mkdtemp(prefix="brewlens-test-")
    rec = {"post_id": "p1", "title": "t", "text": None, "author": None, "score": 7, "upvote_ratio": 0.9,
           "num_comments": 3, "created_utc": 0.0, "url": "/r/x/p1", "subreddit": "x",
           "top_comments": [{"body": "b", "score": 2, "created_utc": "2024-01-01T00:00:00"}],
           "flair": None, "scraped_date": "2024-01-01", "mentioned_drinks": ["latte"]}
    for src, day, n in [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", "2024-01-01", 3)]:
        os.makedirs(f"{root}/{src}", exist_ok=True)
        with open(f"{root}/{src}/{day}.json", "w") as fh:
            json.dump([dict(rec, post_id=f"{src}{day}{i}") for i in range(n)], fh, indent=2)
    df = IG.read_json_records(spark, f"{root}/*/*.json", multiline=True) \
        .withColumn("source", F.regexp_extract("_file", r"/([ab])/[^/]+$", 1))
    assert df.count() == 6
    newest = IG.newest_file_per_source(df)
    assert sorted((r["source"], r["n"]) for r in newest.groupBy("source").agg(F.count("*").alias("n")).collect()) \
        == [("a", 2), ("b", 3)]
    raw = IG.discussions_to_raw_posts(df).first()
    assert raw["author"] == "[deleted]" and raw["body"] == "" and raw["url"] == "https://reddit.com/r/x/p1"


def test_save_posts_is_insert_ignore(spark):
    target = spark.createDataFrame([("1", "A")], "id string, body string")
    batch = spark.createDataFrame([("1", "B"), ("2", "C"), ("2", "D")], "id string, body string")
    out = IG.save_posts(target, batch)
    assert sorted((r.id, r.body) for r in out.collect()) == [("1", "A"), ("2", "C")]


def test_stream_ingest_is_replay_safe(spark):
    root = tempfile.mkdtemp(prefix="brewlens-stream-")
    rows = [(str(i), "t", "u", None, 0.1) for i in range(20)]
    schema = "id string, term string, post_id string, created_at timestamp, sentiment double"
    spark.createDataFrame(rows, schema).write.json(f"{root}/land/a")
    spark.createDataFrame(rows[:5], schema).write.json(f"{root}/land/b")
    sch = spark.createDataFrame([], schema).schema
    ST.ingest(spark, f"{root}/land/*", sch, ["id"], f"{root}/t", f"{root}/ck", max_files_per_trigger=1)
    assert spark.read.parquet(f"{root}/t").count() == 20
    ST.ingest(spark, f"{root}/land/*", sch, ["id"], f"{root}/t", f"{root}/ck2")  # replay from scratch
    assert spark.read.parquet(f"{root}/t").count() == 20
