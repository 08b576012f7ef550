"""Late rows are added to the days that had been told already; replayed batches change nothing."""

import datetime as dt

from pyspark.sql import functions as F

from brewlens.streaming import stream as ST

SCHEMA = "created_at timestamp, term string, sentiment double"


def row(day, term, s):
    return (dt.datetime(2024, 1, day, 12), term, s)


FIRST = [row(1, "a", 0.5), row(1, "b", None), row(9, "a", -0.5), row(10, "a", 0.1)]
LATE = [row(1, "a", -0.9), row(7, "a", 0.4), row(9, "b", 0.0), row(10, "a", 0.9)]


def figures(spark, path):
    return {(r["day"].day, r["term"]): (r["mention_count"], round(r["sentiment_sum"], 6), r["sentiment_count"], r["positive_mentions"],
                                        r["negative_mentions"], r["late_mentions"]) for r in ST.open_partials(spark, path).read().collect()}


def test_a_row_days_late_is_added_and_counted(spark, tmp_path):
    path, land, ckpt = (str(tmp_path / n) for n in ("p", "land", "ckpt"))
    for part, rows in (("a", FIRST), ("b", LATE)):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{land}/{part}")
        ST.merge_partials(spark.readStream.schema(SCHEMA).parquet(f"{land}/*"), path, ckpt)
    want = {(1, "a"): (2, -0.4, 2, 1, 1, 1), (1, "b"): (1, 0.0, 0, 0, 0, 0), (7, "a"): (1, 0.4, 1, 1, 0, 1),
            (9, "a"): (1, -0.5, 1, 0, 1, 0), (9, "b"): (1, 0.0, 1, 0, 0, 0), (10, "a"): (2, 1.0, 2, 1, 0, 0)}
    assert figures(spark, path) == want
    # the last batch again by its id, as after a lost run
    ST.merge_batch(spark.createDataFrame(LATE, SCHEMA), "batch-1", path)
    assert figures(spark, path) == want
    # the roll-up equals that of all rows at once
    partials = ST.open_partials(spark, path).read().withColumn("window_start", F.col("day").cast("timestamp"))
    rolled = {r["term"]: (r["mention_count"], round(r["avg_sentiment"], 6)) for r in ST.rollup_partials(partials, "2024-01-11", 30).collect()}
    assert rolled == {"a": (6, round((0.5 - 0.5 + 0.1 - 0.9 + 0.4 + 0.9) / 6, 6)), "b": (2, 0.0)}


def test_empty_batch(spark, tmp_path):
    ST.merge_batch(spark.createDataFrame([], SCHEMA), "none", str(tmp_path))
    assert ST.open_partials(spark, str(tmp_path)).read().count() == 0
