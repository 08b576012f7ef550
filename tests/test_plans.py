"""Plan shape: anti-joins, pushdown, no cartesian products, no Python in text jobs."""

import pytest

import __spark_entry__ as E
from brewlens.plans.queries import REGISTRY
from conftest import SMALL

ROWS_ONLY = {"fuzzy_best_match", "entity_create_leaders", "link_all"}
EAGER = {"upper_median", "json_roundtrip", "stream_ingest_equals_batch", "stream_windows", "link_all",
         "entity_create_leaders", "link_stats", "link_mentions", "link_reviews", "link_dimensions",
         # these write tables and read them back: the last plan is a scan
         "link_backlog", "stream_link", "stream_late", "stream_extract", "stream_rollup", "keyed_upsert", "keyed_insert_ignore",
         "keyed_writeback", "name_create_known"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_cartesian_product(spark, name):
    p = plan(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["term_facts", "extract_all", "brand_pattern", "origin_norm", "lexicon_hits",
                                  "keywords_topn", "clean_text", "page_fields", "menu_infer", "alias_lookup"])
def test_text_jobs_stay_in_the_jvm(spark, name):
    p = plan(E.queries()[name](spark, SMALL))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_backlog_is_an_anti_join(spark):
    for name in ("backlog_anti", "not_exists"):
        assert "LeftAnti" in plan(E.queries()[name](spark, SMALL))


def test_ranking_filter_reaches_the_scan(spark):
    df = E.queries()["term_ranking_week"](spark, SMALL)
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in s


def test_similarity_verification_is_vectorised(spark):
    p = plan(E.queries()["fuzzy_best_match"](spark, SMALL))
    assert "ArrowEvalPython" in p and "BatchEvalPython" not in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "popularity_rank" in df.columns
