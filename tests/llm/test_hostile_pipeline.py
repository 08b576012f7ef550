"""The pipeline's stages on nulls, empties, repeated ids and rows, very long texts and clashing columns."""

import random
from collections import Counter

import corpus_pipeline
from helpers import doc_words, frame, hostile_texts, rows

from brewlens.llm import mixing, ngram_join


def test_stages_on_hostile_rows(spark, tmp_path):
    r = random.Random(12)
    long = " ".join(f"z{r.randrange(9000)}" for _ in range(30_000))
    data = rows(hostile_texts()) + [(4, "an id of its own again " * 12, None, None, 0), (None, "no id at all", None, "s0", 0),
                                    (None, None, None, None, None), (9000, long, "en", "s1", 0), (9001, long + " more", "en", "s1", 0)]
    data += [data[30], data[30]]
    docs = frame(spark, data, clash=True)
    texts = [d[1] for d in data if d[0] is not None]
    labels = [(i, int(len(doc_words(d[1])) > 3), 0) for i, d in enumerate(data[:60])] + [(None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = mixing.written(stage(spark, docs, str(tmp_path)), "hostile-stage")
        after = docs.collect()
        if k < 4:
            assert docs.columns == columns, name
            assert not Counter(map(str, after)) - Counter(map(str, before)), name       # nothing is made up or repeated
        if k == 1:
            with_id = [x["text"] or "" for x in after if x["doc_id"] is not None]
            assert len(with_id) == len(set(with_id)) and set(with_id) <= {t or "" for t in texts}
            want = {}
            for x in before:
                if x["doc_id"] is not None:
                    want[x["text"] or ""] = max(want.get(x["text"] or "", -1), x["doc_id"])
            assert {(x["doc_id"], x["text"] or "") for x in after if x["doc_id"] is not None} == {(i, t) for t, i in want.items()}
        elif k == 4:
            got = Counter()
            for x in after:
                got[x["doc_id"]] += x["n_tokens"]
            want = Counter()
            for x in before:
                want[x["doc_id"]] += len(doc_words(x["text"])) + 1
            assert got == want


def test_near_copies_of_a_very_long_text_and_of_a_repeated_id(spark):
    r = random.Random(3)
    long = [f"z{r.randrange(9000)}" for _ in range(30_000)]
    near = list(long)
    for _ in range(400):
        near[r.randrange(len(near))] = "changed"
    base = [f"b{i}" for i in range(60)]
    data = rows([" ".join(long), " ".join(near), " ".join(base), " ".join(base[:-1] + ["other"]), "a text of its own " * 9])
    data.append((3, "the id three comes again with words that nobody else has", "en", "s", 0))
    left = sorted((x["doc_id"], len(x["text"])) for x in ngram_join.deduplicate(frame(spark, data)).collect())
    assert left == sorted((d[0], len(d[1])) for k, d in enumerate(data) if k in (0, 2, 4, 5))


def test_an_empty_table_goes_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = mixing.written(stage(spark, docs, str(tmp_path)), "empty-stage")
    assert docs.count() == 0
