"""The stored tables of linking, written run by run.

``LinkStore`` keeps mention rows, entities, origins, reviews and the ledger of
linked reviews as keyed tables (:mod:`brewlens.operators.keyed`), so a run reads and
replaces only the buckets it touches.

A run has a name of its own (a micro-batch id, a date).  It is planned first:
what it will add is computed against the stored tables and written under
``runs/<name>`` with its statistics, which Spark observes while it writes.
Only then is it applied, the ledger last.  Applying is a set of keyed writes,
so a run that was lost at any point is repeated by its name: a finished plan
is applied again as it stands and changes nothing, an unfinished one is made
anew against tables it has not touched yet.  One run at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brewlens.operators import linktables as LT
from brewlens.operators.keyed import KeyedTable
from brewlens.session import merging, path_exists

ARRAYS = ["mentioned_flavor_ids", "mentioned_roaster_ids", "mentioned_origins"]
TABLES = {
    "flavor_extractions": (["processed_review_id", "flavor_term_id"],
                           "processed_review_id long, flavor_term_id long, post_id string, mention_text string, "
                           "sentence_context string, intensity string, sentiment double, confidence_score double, "
                           "is_primary_flavor boolean, mention_order int"),
    "coffee_mentions": (["post_id", "roaster_id", "mention_text"],
                        "post_id string, roaster_id long, mention_text string, coffee_product_id long, mention_context string, "
                        "confidence_score double"),
    "entities": (["id"], "id long, entity_type string, name string, slug string, verified boolean"),
    "origins": (["normalized_name"], "id long, country string, region string, normalized_name string"),
    "reviews": (["id"], "id long, mentioned_flavor_ids array<long>, mentioned_roaster_ids array<long>, "
                        "mentioned_origins array<string>"),
    "ledger": (["processed_review_id"], "processed_review_id long"),
}
_PLAN = ["flavor_extractions", "coffee_mentions", "new_entities", "new_origins", "linked_reviews", "linked_ids"]


class LinkStore:
    """Open the store under ``path``; :meth:`create` makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.tables = {name: KeyedTable(spark, f"{path}/{name}") for name in TABLES}

    @classmethod
    def create(cls, spark: SparkSession, path: str, given: dict[str, DataFrame], buckets: int = 64) -> LinkStore:
        """A store that begins with the tables in ``given`` (any of TABLES, with these columns at least)."""
        for name, (keys, schema) in TABLES.items():
            empty = spark.createDataFrame([], schema)
            rows = given[name].select([F.col(f.name).cast(f.dataType) for f in empty.schema]) if name in given else empty
            KeyedTable.create(rows, f"{path}/{name}", keys, buckets)
        return cls(spark, path)

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def link(self, extractions: DataFrame, flavor_terms: DataFrame, run: str, context_chars: int | None = None) -> dict:
        """Link the reviews of ``extractions`` that the ledger lacks; returns the run's statistics.

        ``extractions``: processed_review_id, post_id, flavors, roasters, origins.
        """
        stats = self._planned(run)
        if stats is None:
            stats = self._plan(extractions, flavor_terms, run, context_chars)
        self._apply(run)
        return stats

    def _planned(self, run: str) -> dict | None:
        marker = f"{self.path}/runs/{run}/_planned"
        if not path_exists(self.spark, f"{marker}/_SUCCESS"):
            return None
        return json.loads(self.spark.read.schema("stats string").json(marker).first()["stats"])

    def _plan(self, extractions: DataFrame, flavor_terms: DataFrame, run: str, context_chars) -> dict:
        ids = extractions.select(F.col("processed_review_id").alias("id")).distinct()
        empty = [F.coalesce(c, F.array().cast(self.tables["reviews"].schema[c].dataType)).alias(c) for c in ARRAYS]
        reviews = ids.join(merging(self.read("reviews")), "id", "left").select("id", *empty)
        made = LT.link_reviews(extractions, reviews, flavor_terms, self.read("entities"), self.read("origins"),
                               self.read("ledger"), context_chars)
        lists = [F.sum(F.size(c)).alias(c) for c in ARRAYS]
        measures = {
            "flavor_extractions": [F.count(F.lit(1)).alias("flavor_rows")],
            "coffee_mentions": [F.count(F.lit(1)).alias("mention_rows"), F.count("coffee_product_id").alias("products_linked")],
            "new_entities": [F.count(F.lit(1)).alias("entities_created")],
            "new_origins": [F.count(F.lit(1)).alias("origins_created")],
            "linked_reviews": [*lists, F.count_if(F.size(ARRAYS[0]) > 0).alias("reviews_with_flavors"),
                               F.count_if(F.size(ARRAYS[1]) > 0).alias("reviews_with_roasters")],
            "linked_ids": [F.count(F.lit(1)).alias("reviews_linked")],
        }
        stats: dict = {"run": run}
        for name in _PLAN:
            seen = Observation(name)
            made[name].observe(seen, *measures[name]).write.mode("overwrite").parquet(f"{self.path}/runs/{run}/{name}")
            stats.update({k: v or 0 for k, v in seen.get.items()})
        for old, new in zip(ARRAYS, ("flavors_linked", "roasters_linked", "origins_linked")):
            stats[new] = stats.pop(old)
        done = self.spark.createDataFrame([(json.dumps(stats),)], "stats string").coalesce(1)
        done.write.mode("overwrite").json(f"{self.path}/runs/{run}/_planned")
        return stats

    def _apply(self, run: str) -> None:
        new = {name: self.spark.read.parquet(f"{self.path}/runs/{run}/{name}") for name in _PLAN}
        self.tables["entities"].upsert_into(new["new_entities"], ["name"])
        self.tables["origins"].insert_ignore_into(new["new_origins"])
        self.tables["flavor_extractions"].insert_ignore_into(new["flavor_extractions"])
        self.tables["coffee_mentions"].insert_ignore_into(new["coffee_mentions"])
        self.tables["reviews"].upsert_into(new["linked_reviews"], ARRAYS)
        self.tables["ledger"].insert_ignore_into(new["linked_ids"])

    def run_statistics(self) -> DataFrame:
        """One row per run: run and the statistics Spark observed while its plan was written."""
        fields = ["flavors_linked", "roasters_linked", "origins_linked", "products_linked", "reviews_with_flavors",
                  "reviews_with_roasters", "reviews_linked", "entities_created", "origins_created", "flavor_rows", "mention_rows"]
        told = self.spark.read.schema("stats string").json(f"{self.path}/runs/*/_planned")
        return told.select(F.from_json("stats", "run string, " + ", ".join(f"{f} long" for f in fields)).alias("s")).select("s.*")
