"""The link queries cover the documents, not only the reviews made of part rows."""

import os

import __spark_entry__ as E
from conftest import SMALL


def test_documents_are_linked(spark, tmp_path):
    for name in os.listdir(SMALL):
        if name != "documents.parquet":
            os.symlink(f"{SMALL}/{name}", tmp_path / name)
    texts = [(1, "en", "A cup from Blue Harbor Coffee today. It had chocolate notes from Kenya."), (2, "en", "short"),
             (3, "en", "Nothing is named in this text at all."), (4, "en", "Blue Harbor Coffee again, and caramel.")]
    spark.createDataFrame(texts, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    parts = spark.read.parquet(f"{SMALL}/part.parquet").count()
    run = {name: E.queries()[name](spark, str(tmp_path)).collect() for name in ("link_mentions", "link_reviews", "link_dimensions")}

    said = sorted((r["post_id"], r["slug"], r["mention_text"]) for r in run["link_mentions"] if not r["post_id"].startswith("-"))
    assert said == [("1", "blue-harbor", "Blue Harbor"), ("4", "blue-harbor", "Blue Harbor")]
    reviews = {r["id"]: r for r in run["link_reviews"]}
    assert len(reviews) == parts + 3 and {i for i in reviews if i >= 0} == {1, 3, 4}      # text 2 has under 10 characters
    assert [(reviews[i]["roasters"], reviews[i]["n_origins"]) for i in (1, 3, 4)] == [("blue-harbor", 1), ("", 0), ("blue-harbor", 0)]
    assert reviews[1]["flavor_ids"] and not reviews[3]["flavor_ids"] and reviews[4]["flavor_ids"]
    assert [(r["name"], r["state"]) for r in run["link_dimensions"] if r["key"] == "blue-harbor"] == [("Blue Harbor", "new")]
