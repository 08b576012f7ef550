"""Data-quality and inventory reports as aggregates (one-row or small tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX

SELECT_BUCKETS = 4096


def upper_median(df: DataFrame, col: str, out: str = "median") -> DataFrame:
    """``sorted(values)[n // 2]`` (the upper median) without a global sort.

    Distributed selection: count, then repeatedly histogram the remaining
    value range into ``SELECT_BUCKETS`` equal-width buckets (a partial
    aggregate: at most 4,098 rows reach the driver), keep the bucket holding
    the wanted rank, and stop when the range is one value.  The least and the
    greatest value never share a bucket, so every pass narrows the range.  A
    hot value holding a third of the rows ends the loop at once.  Nulls are
    not values.
    """
    spark = df.sparkSession
    x = df.select(F.col(col).alias("x")).where(F.col("x").isNotNull())
    n = x.count()
    if n == 0:
        return spark.createDataFrame([(None,)], f"{out} double").select(F.col(out).cast(df.schema[col].dataType))
    k = n // 2
    sub = x
    while True:
        st = sub.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
        mn, mx = st["mn"], st["mx"]
        if mn == mx:
            break
        b = F.width_bucket(F.col("x"), F.lit(mn), F.lit(mx), F.lit(SELECT_BUCKETS))
        hist = sorted((r["b"], r["c"]) for r in sub.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect())
        seen = 0
        for bucket, cnt in hist:
            if seen + cnt > k:
                k -= seen
                sub = sub.where(b == F.lit(bucket))
                break
            seen += cnt
    return spark.range(1).select(F.lit(mn).cast(df.schema[col].dataType).alias(out))


def date_span(df: DataFrame, col: str) -> DataFrame:
    """Oldest, newest (as dates) and whole days between them (not calendar days)."""
    t = F.col(col).cast("timestamp")
    return df.agg(F.min(t).alias("mn"), F.max(t).alias("mx")).select(
        F.date_format("mn", "yyyy-MM-dd").alias("oldest"),
        F.date_format("mx", "yyyy-MM-dd").alias("newest"),
        F.floor((F.unix_micros("mx") - F.unix_micros("mn")) / F.lit(86_400_000_000)).cast("long").alias("span_days"))


def group_share(df: DataFrame, key: str) -> DataFrame:
    """Counts per group with percent of all rows and the grand total.

    The total is a scalar subquery: no task sees all groups.
    """
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return g.select(key, "n", (F.col("n") * 100.0 / total).alias("pct"), total.alias("total"))


def quality_report(posts: DataFrame) -> DataFrame:
    """One-row quality report over posts(score, text, n_comments).

    total, comment total and mean, score min/max/mean, shares of high-score
    posts, posts with text and posts with comments, and the threshold flags.
    """
    s = F.col("score")
    has_text = F.coalesce(F.length("text") > 0, F.lit(False))
    rep = posts.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("n_comments").cast("long").alias("total_comments"),
        F.min(s).alias("min_score"), F.max(s).alias("max_score"), F.avg(s).alias("avg_score"),
        F.count_if(s >= LX.HIGH_QUALITY_SCORE).alias("high_quality"),
        F.avg((s >= LX.HIGH_QUALITY_SCORE).cast("int")).alias("high_quality_share"),
        F.avg(has_text.cast("int")).alias("with_text_share"),
        F.avg((F.col("n_comments") > 0).cast("int")).alias("with_comments_share"),
        F.avg("n_comments").alias("avg_comments"))
    flags = [F.when(_cmp(F.col(metric), op, th), F.lit(flag)) for flag, metric, op, th in LX.QUALITY_FLAGS]
    return rep.withColumn("flags", F.array_compact(F.array(*flags)))


def _cmp(c, op, th):
    return c < th if op == "<" else c >= th


def readiness(menu_items: DataFrame, posts: DataFrame) -> DataFrame:
    """Inventory and readiness checks: item and post totals, number of sources."""
    m = menu_items.agg(F.count(F.lit(1)).alias("menu_items"),
                       F.count_distinct("source").alias("sources"))
    p = posts.agg(F.count(F.lit(1)).alias("posts"))
    from brewlens.operators.metrics import one_row
    j = one_row(m, p)
    return j.select("*",
                    (F.col("menu_items") >= LX.READINESS["min_menu_items"]).alias("menu_ready"),
                    (F.col("posts") >= LX.READINESS["min_posts"]).alias("posts_ready"),
                    (F.col("sources") >= LX.READINESS["min_sources"]).alias("sources_ready"))


def backlog_counts(raw: DataFrame, processed: DataFrame, raw_key: str, proc_key: str) -> DataFrame:
    """``COUNT(*), COUNT(pr.id), difference`` of ``raw LEFT JOIN processed``.

    The processed side is reduced to one row per key with its multiplicity
    before the join, so the fan-out is counted, never materialised.
    """
    per_key = processed.groupBy(F.col(proc_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    j = raw.select(F.col(raw_key).alias("_k")).join(per_key, "_k", "left")
    out = j.agg(F.sum(F.coalesce("_n", F.lit(1))).cast("long").alias("total_raw"),
                F.sum(F.coalesce("_n", F.lit(0))).cast("long").alias("processed_count"))
    return out.withColumn("unprocessed_count", F.col("total_raw") - F.col("processed_count"))


def backlog(raw: DataFrame, processed: DataFrame, raw_key: str, proc_key: str) -> DataFrame:
    """Raw rows without a processed row (``LEFT JOIN ... IS NULL`` / ``NOT EXISTS``)."""
    return raw.join(processed.select(F.col(proc_key).alias(raw_key)), raw_key, "left_anti")


def first_k_then_filter(df: DataFrame, group: str, order: str | list[str], k: int, keep) -> DataFrame:
    """First ``k`` rows per group in ``order``, then the predicate ``keep``.

    ``row_number() <= k`` is planned with a partial window-group limit before
    the shuffle, so a hot group is cut to k rows per input partition.
    """
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn").where(keep)


def catalog_counts(spark: SparkSession, tables: dict[str, DataFrame], wanted: Sequence[str]) -> DataFrame:
    """Row count per wanted table; a missing table gets a status, not an error."""
    parts = []
    for name in wanted:
        if name in tables:
            parts.append(tables[name].agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("table_name"), F.col("row_count"),
                                 F.when(F.col("row_count") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status")))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"),
                                               F.lit(0).cast("long").alias("row_count"),
                                               F.lit("missing").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def inventory(spark: SparkSession, wanted: Sequence[str]) -> DataFrame:
    """Tables and views of the session's catalog that are wanted, by name: status, rows, columns and the row that
    sorts first as JSON (values as text).  A name the catalog lacks is reported as missing.
    """
    known = {t.name for t in spark.catalog.listTables()}
    parts = []
    for name in sorted(wanted):
        if name not in known and not spark.catalog.tableExists(name):
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("missing").alias("status"),
                                               F.lit(0).cast("long").alias("row_count"), F.lit(None).cast("string").alias("columns"),
                                               F.lit(None).cast("string").alias("sample")))
            continue
        table = spark.table(name)
        told = table.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*table.columns)).alias("first"))
        sample = F.to_json(F.struct(*[F.col("first")[c].cast("string").alias(c) for c in table.columns]))
        parts.append(told.select(F.lit(name).alias("table_name"), F.when(F.col("n") > 0, "ok").otherwise("empty").alias("status"),
                                 F.col("n").alias("row_count"), F.lit(",".join(table.columns)).alias("columns"),
                                 F.when(F.col("n") > 0, sample).alias("sample")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")
