"""The tables that linking writes, from stored extractions of reviews not linked yet.

``link_reviews`` takes the stored extractions (one row per review) and the
dimension tables and returns the new snapshots as DataFrames.  A ledger of
linked review ids replaces the polling for unlinked reviews: linked reviews
are anti-joined away, so a second run over the same input adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX
from brewlens.functions import text as T
from brewlens.operators import link as L
from brewlens.operators.upsert import dedupe, ids_writeback, insert_ignore, upsert
from brewlens.session import checkpoint_root, merging


def link_reviews(extractions: DataFrame, reviews: DataFrame, flavor_terms: DataFrame, entities: DataFrame,
                 origins: DataFrame, ledger: DataFrame, context_chars: int | None = None) -> dict[str, DataFrame]:
    """Link the reviews that the ledger lacks.

    ``extractions``: processed_review_id, post_id, flavors, roasters, origins.
    ``reviews``: id and the three id arrays.  ``entities``: id, entity_type,
    name, slug, verified.  ``origins``: id, country, region, normalized_name.
    ``ledger``: processed_review_id.  ``context_chars`` cuts the contexts
    (None: as extracted).

    Returns flavor_extractions (new rows), coffee_mentions (new rows),
    entities, origins, reviews and ledger (new snapshots); and what is new of the last four as
    new_entities, new_origins, linked_reviews and linked_ids.
    """
    checkpoint_root(extractions.sparkSession)
    todo = extractions.join(merging(ledger.select("processed_review_id")), "processed_review_id", "left_anti").checkpoint()
    key = F.col("processed_review_id")
    # flavors
    facts = todo.select("processed_review_id", "post_id", F.posexplode("flavors").alias("pos", "f")).select(
        "processed_review_id", "post_id", "pos", *[F.col(f"f.{c}").alias(c) for c in
                                                   ("term", "context", "intensity", "sentiment", "confidence", "is_primary")])
    flavor_rows = L.link_flavors(facts, L.flavor_alias_table(flavor_terms), context_chars).checkpoint()
    # roasters
    said = todo.select("processed_review_id", "post_id", F.posexplode("roasters").alias("pos", "r"))
    order = F.struct(key, "pos")
    said = said.select("processed_review_id", "post_id", "pos", order.alias("probe_id"), order.alias("seq"),
                       F.col("r.name").alias("name"), F.col("r.context").alias("context"))
    resolved = L.create_entities(said.select("probe_id", "seq", "name"), entities.select("id", "name", "slug", "entity_type")) \
        .checkpoint()
    linked = said.join(merging(resolved.select("probe_id", "entity_id", "method")), "probe_id")
    context = F.coalesce("context", F.lit(""))
    mentions = dedupe(linked.select(
        "post_id", F.col("entity_id").alias("roaster_id"), F.lit(None).cast("long").alias("coffee_product_id"),
        F.col("name").alias("mention_text"),
        (context if context_chars is None else F.substring(context, 1, context_chars)).alias("mention_context"),
        F.lit(LX.ROASTER_MENTION_CONFIDENCE).alias("confidence_score"), "pos"),
        ["post_id", "roaster_id", "mention_text"], ["pos"], "first").drop("pos")
    # a new entity takes the name of the last mention that created its slug
    made = resolved.where(F.col("method") == "created").select(
        F.col("entity_id").alias("id"), F.lit("roaster").alias("entity_type"), "name", T.slugify("name").alias("slug"),
        F.lit(False).alias("verified"), "seq")
    first_of_name = dedupe(made.withColumn("_norm", T.normalize_name("name")), ["id", "_norm"], ["seq"], "first").drop("_norm")
    new_entities = dedupe(first_of_name, ["id"], ["seq"], "last").drop("seq")
    entity_table = upsert(entities, new_entities.select(entities.columns), ["id"], ["name"])
    # origins
    named = todo.select("processed_review_id", F.posexplode("origins").alias("pos", "country"))
    lookup, origin_table = L.find_or_create_origins(origins, named.select("country", F.lit(None).cast("string").alias("region")))
    placed = named.select("processed_review_id", "pos", T.origin_key("country").alias("normalized_name")) \
        .join(merging(lookup.select("normalized_name", "origin_id")), "normalized_name")
    # the three arrays on the review
    done = ids_writeback(reviews, flavor_rows.select(key.alias("id"), "flavor_term_id", "mention_order"), "id",
                         "flavor_term_id", "mention_order", "mentioned_flavor_ids")
    done = ids_writeback(done, linked.select(key.alias("id"), "entity_id", "pos"), "id", "entity_id", "pos",
                         "mentioned_roaster_ids")
    done = ids_writeback(done, placed.select(key.alias("id"), F.col("origin_id").cast("string").alias("origin_id"), "pos"), "id",
                         "origin_id", "pos", "mentioned_origins")
    new_ledger = insert_ignore(ledger.select("processed_review_id"), todo.select("processed_review_id"), ["processed_review_id"])
    new_origins = lookup.where("created").select(F.col("origin_id").alias("id"), "country", "region", "normalized_name")
    linked_ids = todo.select("processed_review_id").distinct()
    linked = done.join(merging(linked_ids.select(F.col("processed_review_id").alias("id"))), "id", "left_semi")
    return {"flavor_extractions": flavor_rows, "coffee_mentions": mentions, "entities": entity_table,
            "origins": origin_table, "reviews": done, "ledger": new_ledger,
            "new_entities": new_entities.select(entities.columns), "new_origins": new_origins, "linked_reviews": linked,
            "linked_ids": linked_ids}
