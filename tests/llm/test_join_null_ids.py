"""A copy without id in front of a text does not take its links away."""

from helpers import frame

from brewlens.llm import ngram_join


def test_null_id_copy_in_front(spark):
    a = [f"w{i}" for i in range(60)]
    text, near = " ".join(a), " ".join(a[:-1] + ["other"])
    data = [(None, text, "en", "s", 0), (1, text, "en", "s", 0), (2, near, "en", "s", 0)]
    out = ngram_join.join(frame(spark, data).coalesce(1)).collect()
    assert {(r["doc_id"], r["component_id"], r["n_links"]) for r in out} == {(None, None, 0), (1, 1, 1), (2, 1, 1)}
