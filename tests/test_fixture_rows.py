"""Remaining FIXTURES.md hand rows."""

from pyspark.sql import functions as F

from brewlens.functions import lexicons as LX
from brewlens.operators import extract as X
from brewlens.operators import link as L


def test_alias_last_wins(spark):
    ft = spark.createDataFrame([(1, "cocoa", "cocoa", ["cacao"]), (2, "cacao", "cacao", [])],
                               "id long, term string, normalized_term string, synonyms array<string>")
    a = {r.alias: r.flavor_term_id for r in L.flavor_alias_table(ft).collect()}
    assert a["cacao"] == 2 and a["cocoa"] == 1


def test_exact_ignores_type_fuzzy_respects_it(spark):
    ents = spark.createDataFrame([(1, "ritual", "ritual", "cafe"), (2, "rituals", "rituals", "cafe")],
                                 "id long, name string, slug string, entity_type string")
    cache = L.entity_cache(ents)
    probes = spark.createDataFrame([(10, "Ritual", "roaster"), (11, "Rituall", "roaster"), (12, "Rituall", "cafe")],
                                   "probe_id long, name string, entity_type string")
    got = {r.probe_id: (r.entity_id, r.method) for r in L.match_entities(probes, cache).collect()}
    assert got[10] == (1, "exact")
    assert 11 not in got
    assert got[12][1] == "fuzzy"


def test_confidence_cases(spark):
    # short / long context, without and with a strong sentiment word
    text = "rose. great lemon. a long sentence with some lime in it. a long sentence, perfect berry here."
    facts = {f["term"]: f["confidence"] for f in
             X.flavor_facts(spark.createDataFrame([(text,)], "t string"), "t").first()["flavors"]}
    assert facts["rose"] == 0.6 and facts["lemon"] == 0.7
    assert facts["lime"] == 0.75 and facts["berry"] == 0.85


def test_engagement_filter(spark):
    df = spark.createDataFrame([(5, 3), (4, 9), (9, 2)], "score long, n long")
    kept = df.where((F.col("score") >= LX.ENGAGEMENT_MIN_SCORE) & (F.col("n") >= LX.ENGAGEMENT_MIN_COMMENTS))
    assert [tuple(r) for r in kept.collect()] == [(5, 3)]
