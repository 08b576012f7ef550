"""The stored tables of linking: runs in parts, replays, and a plan that was lost half-way."""

import pytest

from brewlens.operators import linkstore as LS
from brewlens.operators import linktables as LT

FACT = "array<struct<term:string,ord:int,context:string,sentiment:double,intensity:string,confidence:double,is_primary:boolean>>"
SCHEMA = f"processed_review_id long, post_id string, flavors {FACT}, roasters array<struct<name:string,context:string>>, origins array<string>"


def review(i, flavors, roasters, origins):
    return (i, f"p{i}", [(t, 1, f"about {t}", 0.1, "mild", 0.8, True) for t in flavors], [(r, f"at {r}") for r in roasters], origins)


REVIEWS = [review(1, ["chocolate"], ["Blue Harbor Coffee"], ["kenya"]), review(2, [], ["Blue Harbour Coffee"], ["kenya", "peru"]),
           review(3, ["caramel", "chocolate"], ["Stumptown"], []), review(4, [], [], []),
           review(5, ["caramel"], ["blue harbor coffee", "New Place"], ["peru"])]
ENTITIES = [(10, "roaster", "Stumptown", "stumptown", True)]
ORIGINS = [(7, "Kenya", "General", "kenya_general")]


@pytest.fixture
def made(spark, tmp_path):
    terms = spark.createDataFrame([(1, "chocolate", "chocolate", []), (2, "caramel", "caramel", [])],
                                  "id long, term string, normalized_term string, synonyms array<string>")
    given = {"entities": spark.createDataFrame(ENTITIES, LS.TABLES["entities"][1]),
             "origins": spark.createDataFrame(ORIGINS, LS.TABLES["origins"][1])}
    return LS.LinkStore.create(spark, str(tmp_path / "store"), given, buckets=2), terms, given


def content(store):
    return {name: sorted(map(str, store.read(name).select(sorted(store.tables[name].schema.names)).collect())) for name in LS.TABLES}


def test_two_runs_and_replays_equal_one_batch(spark, made):
    store, terms, given = made
    ex = spark.createDataFrame(REVIEWS, SCHEMA)
    reviews = ex.selectExpr("processed_review_id AS id", "cast(array() AS array<long>) AS mentioned_flavor_ids",
                            "cast(array() AS array<long>) AS mentioned_roaster_ids", "cast(array() AS array<string>) AS mentioned_origins")
    ledger = spark.createDataFrame([], "processed_review_id long")
    whole = LT.link_reviews(ex, reviews, terms, given["entities"], given["origins"], ledger)
    one = store.link(ex.where("processed_review_id <= 2"), terms, "monday")
    two = store.link(ex, terms, "tuesday")
    assert (one["reviews_linked"], two["reviews_linked"]) == (2, 3)
    assert (one["entities_created"], two["entities_created"], one["origins_created"], two["origins_created"]) == (1, 1, 1, 0)
    assert (one["origins_linked"], two["origins_linked"], one["products_linked"]) == (3, 1, 0)
    got = content(store)
    for name in LS.TABLES:
        want = whole[name].select(sorted(store.tables[name].schema.names))
        if name == "flavor_extractions":
            assert len(got[name]) == want.count() == 4
        else:
            assert got[name] == sorted(map(str, want.collect())), name
    # replayed runs and a run with nothing new change nothing, and do not hang on empty writes
    assert store.link(ex, terms, "tuesday") == two and store.link(ex, terms, "monday") == one
    three = store.link(ex, terms, "wednesday")
    assert content(store) == got and three["reviews_linked"] == three["mention_rows"] == three["flavors_linked"] == 0
    stats = {r["run"]: r for r in store.run_statistics().collect()}
    assert set(stats) == {"monday", "tuesday", "wednesday"} and stats["tuesday"]["flavors_linked"] == 3


def test_a_run_lost_while_it_was_applied_is_repeated(spark, made, monkeypatch):
    store, terms, _ = made
    ex = spark.createDataFrame(REVIEWS, SCHEMA)
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("executor lost")
        m.setattr(store.tables["reviews"], "upsert_into", lost)
        with pytest.raises(RuntimeError):
            store.link(ex, terms, "monday")
    assert store.read("coffee_mentions").count() == 5 and store.read("ledger").count() == 0
    store.link(ex, terms, "monday")
    assert store.read("coffee_mentions").count() == 5 and store.read("ledger").count() == 5
    assert store.read("reviews").where("size(mentioned_roaster_ids) > 0").count() == 4


def test_no_extractions(spark, made):
    store, terms, _ = made
    stats = store.link(spark.createDataFrame([], SCHEMA), terms, "empty")
    assert stats["reviews_linked"] == 0 and store.read("ledger").count() == 0
