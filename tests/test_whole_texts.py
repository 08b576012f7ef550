"""Whole passages and whole pages: nothing past an opening or a title is left out."""

import __spark_entry__ as E


def test_passages_quoted_from_the_middle(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven")], "bench_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "He said: three four five six!"), (2, "six five")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["term"]) for r in E.queries()["lexicon_table_hits"](spark, str(tmp_path)).collect()}
    assert got == {(1, t) for t in ("three", "four", "five", "six", "three four", "four five", "five six", "three four five", "four five six",
                                        "three four five six")} \
        | {(2, "six"), (2, "five")}


def test_pages_give_their_text(spark, tmp_path):
    html = "<html><head><title>A</title><script>no()</script></head><body><h1>Menu</h1><p>Beans &amp; cups at http://x.y now</p></body></html>"
    spark.createDataFrame([(1, "shop/menu", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "a text of a document")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = {n: {(r["kind"], r["id"]): r for r in E.queries()[n](spark, str(tmp_path)).collect()} for n in ("clean_text", "min_len")}
    assert run["clean_text"]["page", 1]["cleaned"] == "shop/menu A Menu Beans & cups at now"
    assert run["min_len"]["page", 1]["n"] == len("A\nA Menu Beans & cups at http://x.y now")
