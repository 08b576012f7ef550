"""Metric maintenance: rankings, popularity, product and entity metrics.

Domain schemas (see FIXTURES.md): ``flavor_extractions``, ``processed_reviews``,
``flavor_terms``, ``entities``, ``coffee_products``, ``product_reviews``,
``coffee_mentions``.  Every aggregate is a hash aggregate with map-side
partial aggregation; targets are updated with :func:`brewlens.operators.upsert.update_from`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX
from brewlens.operators.upsert import update_from


def period_days(period: str) -> int:
    return LX.PERIOD_DAYS.get(period, LX.OTHER_PERIOD_DAYS)


def _as_date(as_of) -> dt.date:
    return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))


def flavor_rankings(extractions: DataFrame, reviews: DataFrame | None, period: str, as_of,
                    flavor_col: str = "flavor_term_id") -> DataFrame:
    """Period ranking of flavors (one row per flavor with mentions).

    Mentions with ``created_at >= as_of - N days`` (no upper bound) and
    confidence above 0.5, joined to their review for the post id; counts,
    distinct posts, mean sentiment, +/-0.3 counts, and ``RANK`` by mention
    count within (period_type, period_end).  ``as_of`` replaces CURRENT_DATE.
    When ``reviews`` is None the extraction's own ``post_id`` is used (saves
    the join; same result because the extraction carries the review's post).
    """
    as_of_d = _as_date(as_of)
    start_d = as_of_d - dt.timedelta(days=period_days(period))
    # the bound takes the column's own type (TIMESTAMP or TIMESTAMP_NTZ) so the
    # comparison is on the raw column and reaches the parquet scan as a pushed filter
    start = F.lit(f"{start_d.isoformat()} 00:00:00").cast(extractions.schema["created_at"].dataType)
    fe = (extractions
          .where((F.col("created_at") >= start)
                 & (F.col("confidence_score") > LX.RANKING_MIN_CONFIDENCE))
          .select(flavor_col, "processed_review_id", "sentiment",
                  *([] if reviews is not None else ["post_id"])))
    if reviews is not None:
        fe = fe.join(reviews.select(F.col("id").alias("processed_review_id"), "post_id"),
                     "processed_review_id", "inner")
    s = F.col("sentiment")
    agg = (fe.groupBy(F.col(flavor_col).alias("flavor_id"))
           .agg(F.count(F.lit(1)).alias("mention_count"),
                F.count_distinct("post_id").alias("unique_products"),
                F.avg(s).alias("avg_sentiment"),
                F.count_if(s > LX.POSITIVE_SENTIMENT).alias("positive_mentions"),
                F.count_if(s < LX.NEGATIVE_SENTIMENT).alias("negative_mentions")))
    out = agg.select(
        "flavor_id",
        F.lit(start_d).alias("period_start"),
        F.lit(as_of_d).alias("period_end"),
        F.lit(period).alias("period_type"),
        "mention_count", "unique_products", "avg_sentiment",
        "positive_mentions", "negative_mentions")
    return with_popularity_rank(out)


def with_popularity_rank(rankings: DataFrame) -> DataFrame:
    """``RANK() OVER (ORDER BY mention_count DESC)`` per (period_type, period_end).

    After aggregation there is one row per flavor and period, so the window
    partition is bounded by the size of the flavor dimension.
    """
    w = Window.partitionBy("period_type", "period_end").orderBy(F.col("mention_count").desc())
    return rankings.withColumn("popularity_rank", F.rank().over(w).cast("long"))


def upsert_rankings(target: DataFrame, fresh: DataFrame) -> DataFrame:
    """Merge fresh rankings into the stored table on the 4-column key.

    On a key hit only mention_count, avg_sentiment and computed_at change;
    unique_products and the +/- counts keep the stored values.  Ranks are
    then recomputed for every period in the table.
    """
    from brewlens.operators.upsert import upsert
    key = ["flavor_id", "period_start", "period_end", "period_type"]
    merged = upsert(target.drop("popularity_rank"), fresh.drop("popularity_rank"), key,
                    set_cols=["mention_count", "avg_sentiment", "computed_at"])
    return with_popularity_rank(merged)


def flavor_popularity(flavor_terms: DataFrame, extractions: DataFrame) -> DataFrame:
    """total_mentions = count of extractions with confidence > 0.5 per flavor.

    Flavors without such mentions keep their stored (possibly stale) value.
    """
    counts = (extractions.where(F.col("confidence_score") > LX.RANKING_MIN_CONFIDENCE)
              .groupBy(F.col("flavor_term_id").alias("id"))
              .agg(F.count(F.lit(1)).alias("total_mentions")))
    return update_from(flavor_terms, counts, ["id"], ["total_mentions"])


def product_metrics(products: DataFrame, product_reviews: DataFrame, mentions: DataFrame,
                    now=None) -> DataFrame:
    """Product review count / mean rating / mention count.

    Only products with at least one non-null rating are updated; products with
    mentions but no ratings keep their stored values.
    """
    reviews = (product_reviews.where(F.col("overall_rating").isNotNull())
               .groupBy(F.col("product_id").alias("id"))
               .agg(F.count(F.lit(1)).alias("n"), F.avg("overall_rating").alias("avg_r")))
    ment = (mentions.where(F.col("coffee_product_id").isNotNull())
            .groupBy(F.col("coffee_product_id").alias("id"))
            .agg(F.count(F.lit(1)).alias("m")))
    upd = (reviews.join(ment, "id", "left")
           .select("id",
                   F.coalesce("n", F.lit(0)).cast("long").alias("total_ratings"),
                   F.coalesce("avg_r", F.lit(0.0)).alias("avg_rating"),
                   F.coalesce("n", F.lit(0)).cast("long").alias("total_reviews"),
                   F.coalesce("m", F.lit(0)).cast("long").alias("mention_count"),
                   _now(now).alias("updated_at")))
    return update_from(products, upd, ["id"],
                       ["total_ratings", "avg_rating", "total_reviews", "mention_count", "updated_at"])


def entity_metrics(entities: DataFrame, products: DataFrame, mentions: DataFrame,
                   now=None) -> DataFrame:
    """Entity product count, mean of product mean ratings, distinct posts.

    Only entities with at least one product are updated.
    """
    counts = (products.where(F.col("entity_id").isNotNull())
              .groupBy(F.col("entity_id").alias("id"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg("avg_rating").alias("avg_r")))
    posts = (mentions.where(F.col("roaster_id").isNotNull())
             .groupBy(F.col("roaster_id").alias("id"))
             .agg(F.count_distinct("post_id").alias("p")))
    upd = (counts.join(posts, "id", "left")
           .select("id",
                   F.coalesce("n", F.lit(0)).cast("long").alias("product_count"),
                   F.coalesce("avg_r", F.lit(0.0)).alias("avg_product_rating"),
                   F.coalesce("p", F.lit(0)).cast("long").alias("total_reviews"),
                   _now(now).alias("updated_at")))
    return update_from(entities, upd, ["id"],
                       ["product_count", "avg_product_rating", "total_reviews", "updated_at"])


def top_flavors(flavor_terms: DataFrame, k: int = 10) -> DataFrame:
    """Top-k flavors by total_mentions (> 0); ties by term then id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own top k, only k rows per partition reach the final merge.
    """
    return (flavor_terms.where(F.col("total_mentions") > 0)
            .orderBy(F.col("total_mentions").desc(), F.col("term"), F.col("id"))
            .limit(k)
            .select("id", "term", "total_mentions"))


def flavors_with_mentions(flavor_terms: DataFrame) -> DataFrame:
    return flavor_terms.agg(F.count_if(F.col("total_mentions") > 0).alias("flavors_with_mentions"))


def linking_coverage(reviews: DataFrame, extractions: DataFrame, mentions: DataFrame) -> DataFrame:
    """Reviews with >= 1 flavor row and posts with >= 1 roaster mention.

    The two LEFT JOINs of the original fan out per review; counting distinct
    matched keys equals a semi-join count on each side, so each side is
    reduced to its distinct keys first and no fan-out is materialised.
    """
    with_flavors = reviews.select("id").join(
        extractions.select(F.col("processed_review_id").alias("id")).distinct(), "id", "left_semi")
    with_roasters = reviews.select("post_id").join(
        mentions.select("post_id").distinct(), "post_id", "left_semi")
    a = with_flavors.agg(F.count_distinct("id").alias("reviews_with_flavors"))
    b = with_roasters.agg(F.count_distinct("post_id").alias("reviews_with_roasters"))
    return one_row(a, b)


def one_row(*aggs: DataFrame) -> DataFrame:
    """Side-by-side of one-row aggregates without a join.

    The rows are stacked (each column is non-null in exactly one of them) and
    folded by one final aggregate, so no cross product is planned.
    """
    cols = [c for a in aggs for c in a.columns]
    u = aggs[0]
    for a in aggs[1:]:
        u = u.unionByName(a, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in cols])


def review_stats(reviews: DataFrame) -> DataFrame:
    """Count, mean sentiment as NUMERIC(10,2), and counts above/below +/-0.3."""
    s = F.col("sentiment_score")
    return reviews.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.avg(s).cast("decimal(10,2)").alias("avg_sentiment"),
        F.count_if(s > LX.POSITIVE_SENTIMENT).alias("positive_reviews"),
        F.count_if(s < LX.NEGATIVE_SENTIMENT).alias("negative_reviews"))


def _now(now):
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
