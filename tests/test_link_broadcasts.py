"""Linking and the name index broadcast no side of a join that grows with the input (it would pass through the driver)."""

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from brewlens.operators import link as L
from brewlens.operators import linkstore as LS
from brewlens.plans import queries as Q
from brewlens.plans import standins as S
from test_linkstore import ENTITIES, ORIGINS, REVIEWS, SCHEMA


def broadcast_joins(df):
    """The joins that Spark plans as broadcasts, but for the table of flavor aliases."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Broadcast" in line and "Join" in line and "alias#" not in line]


@pytest.fixture
def planned(monkeypatch):
    """The broadcast joins of what is checkpointed or written from here on, and how many plans were looked at."""
    seen = {"plans": 0, "joins": []}

    def note(df):
        seen["plans"] += 1
        seen["joins"] += broadcast_joins(df)

    checkpoint, parquet = DataFrame.checkpoint, DataFrameWriter.parquet

    def noted_checkpoint(self, *a, **k):
        note(self)
        return checkpoint(self, *a, **k)

    def noted_parquet(self, *a, **k):
        note(self._df)
        return parquet(self, *a, **k)

    monkeypatch.setattr(DataFrame, "checkpoint", noted_checkpoint)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted_parquet)
    return seen


def test_linking_merges(spark, tmp_path, planned, monkeypatch):
    given = {"entities": spark.createDataFrame(ENTITIES, LS.TABLES["entities"][1]),
             "origins": spark.createDataFrame(ORIGINS, LS.TABLES["origins"][1])}
    store = LS.LinkStore.create(spark, str(tmp_path / "store"), given, buckets=2)
    terms = spark.createDataFrame([(1, "chocolate", "chocolate", []), (2, "caramel", "caramel", [])],
                                  "id long, term string, normalized_term string, synonyms array<string>")
    ex = spark.createDataFrame(REVIEWS, SCHEMA).coalesce(1)
    store.link(ex.where("processed_review_id <= 2"), terms, "parts")
    store.link(ex, terms, "all")
    assert planned["plans"] > 20 and planned["joins"] == []
    # what the queries read from the store
    monkeypatch.setattr(Q, "_link_store", lambda *_: store)
    for query, rows in (("link_mentions", 5), ("link_reviews", 5), ("link_backlog", 3)):
        out = getattr(Q, query)(spark, "")
        assert broadcast_joins(out) == [], query
        assert out.count() == rows, query


def test_long_names_meet_by_merging(spark):
    """Names of so many characters meet by bigrams."""
    names = [f"the lantern coffee mill of the northern harbor road {i}" for i in range(3)]
    left = spark.createDataFrame([(n, n) for n in names], "lid string, lstr string")
    right = spark.createDataFrame([(n + "s", n + "s") for n in names], "rid string, rstr string")
    out = L.similarity_candidates(left, right)
    assert broadcast_joins(out) == [] and "Window" in out._jdf.queryExecution().sparkPlan().toString()


def test_name_index_merges(spark, tmp_path, planned):
    rows = [(i, f"part {i}") for i in range(90)]
    spark.createDataFrame(rows, "p_partkey long, p_name string").coalesce(1)._jdf.write().parquet(str(tmp_path / "part.parquet"))
    out = Q.name_index_match(spark, str(tmp_path))
    assert planned["plans"] > 10 and planned["joins"] == [] and broadcast_joins(out) == []
    probes = S.known_probes_from_part(spark, str(tmp_path))
    assert broadcast_joins(probes) == [] and probes.count() == 90
    assert {r["method"] for r in out.collect()} == {"exact", "fuzzy"}
